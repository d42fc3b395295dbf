"""The rule catalogs of both services, unchanged, on order lines in the shape of raw trip files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.catalog.quality import EXECUTED
from fareledger.catalog.trips import table
from fareledger.operators import quality
from fareledger.operators.rules import (
    DOMAIN,
    DUPLICATE,
    GREEN_PAYMENTS,
    RATE_CODES,
    REFERENCE,
    SCALAR,
    TRIP_TYPES,
    VENDOR_IDS,
    YELLOW_PAYMENTS,
    of_kind,
    rule_catalog,
)
from fareledger.session import materialize
from fareledger.sources.schemas import GREEN, YELLOW

KEY = "_source_file_id"
# Raw columns as expressions that Spark and DuckDB read alike. Every rule is broken by some lines.
SHARED = {
    "VendorID": "CAST(l_suppkey AS INTEGER)",
    "passenger_count": "CAST(NULLIF(l_linenumber, 6) - 1 AS BIGINT)",
    "trip_distance": "l_quantity - 25e0",
    "RatecodeID": "CAST(NULLIF(l_linenumber, 4) AS BIGINT)",
    "store_and_fwd_flag": "NULLIF(l_returnflag, 'A')",
    "PULocationID": "CAST(c_nationkey + 1 AS INTEGER)",
    "DOLocationID": "CAST(s_nationkey - 1 AS INTEGER)",
    "payment_type": "CAST(l_linenumber + 1 AS BIGINT)",
    "fare_amount": "l_extendedprice * (5e-2 - l_discount)",
    "extra": "5e-2 - l_discount",
    "mta_tax": "4e-2 - l_tax",
    "tip_amount": "l_discount - 5e-2",
    "tolls_amount": "l_quantity - 40e0",
    "improvement_surcharge": "l_tax - 1e-2",
    "total_amount": "o_totalprice - 1e5",
    "congestion_surcharge": "NULLIF(l_discount, 0e0) - 2e-2",
    "Airport_fee": "NULLIF(l_tax, 0e0) - 3e-2",
    "cbd_congestion_fee": "s_acctbal",
    "ehail_fee": "NULLIF(l_tax, 0e0) - 5e-2",
    "trip_type": "CAST(l_linenumber AS BIGINT)",
}
PICKUP = "l_shipdate"
DROPOFF = "CASE WHEN l_returnflag = 'R' THEN o_orderdate ELSE l_shipdate END"
FILE = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT)"
SERVICES = {"yellow": (YELLOW, "tpep", YELLOW_PAYMENTS), "green": (GREEN, "lpep", GREEN_PAYMENTS)}


def columns(service: str) -> dict[str, str]:
    contract, prefix, _ = SERVICES[service]
    times = {f"{prefix}_pickup_datetime": PICKUP, f"{prefix}_dropoff_datetime": DROPOFF}
    return {name: (SHARED | times)[name] for name in contract.names}


def raw_rows(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """All order lines under raw column names; lines of seven-line orders' end come twice."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.unionByName(lines.where("l_linenumber = 7"))
    # Customers meet the few columns of orders, so the lines are shuffled by order only.
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(
        *[F.expr(sql).alias(name) for name, sql in columns(service).items()],
        F.expr(FILE).alias(KEY), F.year("o_orderdate").alias("_source_year"),
        F.month("o_orderdate").alias("_source_month"),
    )


def results(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    rules = rule_catalog(f"{service}_tripdata")
    rows = materialize(raw_rows(spark, sf_dir, service))  # joined once for all scans
    zones = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("LocationID"))
    measures = quality.measure(
        rows, rules, [KEY], zones, "LocationID", SERVICES[service][0].names, prefilter=True
    )
    targets = rows.groupBy(KEY).agg(F.first(KEY).alias("run_id"))
    return quality.quality_results(measures, rules, targets, KEY, EXECUTED).drop("executed_at")


def q_yellow_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir, "yellow")


def q_green_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir, "green")


QUERIES = {"q_yellow_results": q_yellow_results, "q_green_results": q_green_results}


def scalar_condition(name: str, prefix: str) -> str:
    """A scalar rule, written anew as SQL from its name."""
    column = {"airport_fee": "Airport_fee", "rate_code": "RatecodeID",
              "store_and_fwd": "store_and_fwd_flag"}
    if name == "pickup_outside_source_month":
        start = f"{prefix}_pickup_datetime"
        return f"year({start}) * 100 + month({start}) <> {KEY}"
    if name == "dropoff_before_pickup":
        return f"{prefix}_dropoff_datetime < {prefix}_pickup_datetime"
    if name.endswith("_null_rate"):
        base = name.removesuffix("_null_rate")
        return f"{column.get(base, base)} IS NULL"
    sign, base = name.split("_", 1)
    return f"{column.get(base, base)} {'<' if sign == 'negative' else '='} 0"


DOMAINS = {
    "unexpected_vendor_id": ("VendorID", VENDOR_IDS),
    "unexpected_rate_code": ("RatecodeID", RATE_CODES),
    "unexpected_store_and_fwd_flag": ("store_and_fwd_flag", ("N", "Y")),
    "unexpected_trip_type": ("trip_type", TRIP_TYPES),
}
ZONE_COLUMNS = {"unknown_pickup_zone": "PULocationID", "unknown_dropoff_zone": "DOLocationID"}


def results_sql(service: str) -> str:
    contract, prefix, payments = SERVICES[service]
    rules = rule_catalog(f"{service}_tripdata")
    domains = DOMAINS | {"unexpected_payment_type": ("payment_type", payments)}
    parts = [
        f"""SELECT {KEY}, '{r.name}' AS check_name,
        count(*) FILTER (WHERE {scalar_condition(r.name, prefix)}) AS rows_failed,
        CAST(NULL AS VARCHAR) AS details FROM t GROUP BY 1""" for r in of_kind(rules, SCALAR)
    ]
    for rule in of_kind(rules, DOMAIN):
        column, allowed = domains[rule.name]
        bad = f"{column} NOT IN {allowed}"
        parts.append(f"""SELECT {KEY}, '{rule.name}', count(*) FILTER (WHERE {bad}),
        '{{"unexpected_value_count":' || count(DISTINCT CASE WHEN {bad} THEN {column} END) || '}}'
        FROM t GROUP BY 1""")
    for rule in of_kind(rules, REFERENCE):
        column = ZONE_COLUMNS[rule.name]
        parts.append(f"""SELECT {KEY}, '{rule.name}', count(*) FILTER (WHERE {column} IS NOT NULL
        AND {column} NOT IN (SELECT n_nationkey FROM nation)), NULL FROM t GROUP BY 1""")
    for rule in of_kind(rules, DUPLICATE):
        parts.append(f"""SELECT {KEY}, '{rule.name}', coalesce(sum(n) FILTER (WHERE n > 1), 0),
        '{{"duplicate_excess_rows":' || CAST(sum(n - 1) AS BIGINT) || ',"duplicate_groups":'
        || count(*) FILTER (WHERE n > 1) || '}}'
        FROM (SELECT {KEY}, count(*) AS n FROM t GROUP BY {KEY}, {", ".join(contract.names)}) AS g
        GROUP BY 1""")
    listed = ", ".join(f"({i}, '{r.name}', '{r.severity}')" for i, r in enumerate(rules, 1))
    chosen = ", ".join(f"{sql} AS {name}" for name, sql in columns(service).items())
    return f"""
WITH l AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 7),
t AS (SELECT {chosen}, {FILE} AS {KEY} FROM l JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
f AS (SELECT {KEY}, count(*) AS n FROM t GROUP BY 1),
r AS (SELECT * FROM (VALUES {listed}) AS r(ordinal, check_name, severity)),
m AS ({" UNION ALL ".join(parts)})
SELECT f.{KEY} * 1000 + r.ordinal AS quality_result_id, f.{KEY} AS run_id, r.check_name, r.severity,
  CASE WHEN m.rows_failed = 0 THEN 'passed' ELSE 'violated' END AS status, f.n AS rows_checked,
  CAST(m.rows_failed AS BIGINT) AS rows_failed, m.rows_failed / CAST(f.n AS DOUBLE) AS failure_rate,
  m.details
FROM m JOIN f ON m.{KEY} = f.{KEY} JOIN r ON m.check_name = r.check_name"""


ORACLE = {f"q_{service}_results": results_sql(service) for service in SERVICES}
