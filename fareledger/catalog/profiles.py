"""Profiles of trips, documents and lookups in the order tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.catalog.files import FIELDS_CTE, table_fields, table_name
from fareledger.catalog.trips import (
    LINES_SQL,
    TRIPS_CTE,
    ZONES_SQL,
    line_trips,
    table,
    trips,
    zones,
)
from fareledger.operators import profile
from fareledger.session import materialize

NULLABLE = ["vendor_id", "dropoff_datetime", "rate_code_id", "tip_amount", "total_amount"]
NUMERICS = ["passenger_count", "fare_amount", "tip_amount", "total_amount"]
CLOCKS = ["pickup_datetime", "dropoff_datetime"]
ROLES = ["pickup_location_id", "dropoff_location_id"]
DOMAINS = ["payment_type", "store_and_fwd_flag"]
STATS = ["minimum", "p01", "p50", "p95", "p99", "maximum"]
SPEC = profile.ProfileSpec(
    tuple(NULLABLE), tuple(DOMAINS), tuple(NUMERICS), *CLOCKS, tuple(ROLES)
)


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[
        F.round(c, 4).alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.labelled(trips(spark, sf_dir), F.col("service_type"))


def by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.labelled(line_trips(spark, sf_dir), F.col("source_file_id").cast("string"))


def p_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_summary(by_service(spark, sf_dir), NULLABLE)


def p_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.numeric_profile(by_service(spark, sf_dir), NUMERICS), STATS)


def p_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.domain_profile(by_service(spark, sf_dir), DOMAINS)


def p_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.datetime_profile(by_service(spark, sf_dir), CLOCKS)


def p_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.floor(F.col("source_file_id") / 100)
    month = F.pmod(F.col("source_file_id"), F.lit(100))
    return rounded(profile.duration_profile(by_file(spark, sf_dir), *CLOCKS, year, month), STATS)


def p_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.reference_profile(
        by_service(spark, sf_dir), ROLES, zones(spark, sf_dir), "location_id"
    )


def p_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.unmatched_ids(
        by_service(spark, sf_dir), ROLES, zones(spark, sf_dir), "location_id"
    )


def p_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumnRenamed("source", "origin")
    return profile.duplicate_profile(
        profile.labelled(docs, F.col("lang")), ["text", "lang", "origin"]
    )


def p_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = profile.labelled(table(spark, sf_dir, "orders"), F.col("o_orderstatus"))
    return profile.key_profile(orders, "o_custkey")


def p_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a lookup keyed by customer, profiled like the zone file."""
    lookup = profile.labelled(
        table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("LocationID"), F.col("c_mktsegment").alias("Borough"),
            F.col("c_name").alias("Zone"), F.lit("N/A").alias("service_zone"),
        ),
        "lookup",
    )
    parts = profile.lookup_profile(lookup)  # its types are compared by p_types
    whole = F.lit("*")
    return reduce(DataFrame.unionByName, [
        profile.long_format(parts["columns"], "columns"),
        profile.long_format(parts["key"], "key", whole),
        profile.long_counts(parts["domains"], "domain"),
        profile.long_format(parts["duplicates"], "duplicates", whole),
    ])


def _service(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each section scans the rows: they are joined once, and the columns looked at are stored.
    used = dict.fromkeys([profile.SOURCE, *SPEC.columns, *SPEC.domains, *SPEC.numerics, *CLOCKS, *ROLES])
    rows = profile.profile_service(
        materialize(by_service(spark, sf_dir).select(*used)), SPEC, zones(spark, sf_dir), "location_id", 1996, 6
    )
    return rounded(rows, ["number"])


def p_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _service(spark, sf_dir)


def p_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.profile_compare(_service(spark, sf_dir), "line", "order"), ["delta"])


def p_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types read out of order cells as text, by order status."""
    orders = table(spark, sf_dir, "orders")
    late = F.year("o_orderdate") > 1996
    cells = orders.select(
        F.col("o_orderstatus").alias("source"), F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_orderstatus",
        F.when(late, F.col("o_custkey").cast("string")).alias("o_clerk_number"),
        late.cast("string").alias("o_late"), F.when(late, F.lit("False")).alias("o_rare"),
        F.lit(None).cast("string").alias("o_nothing"),
        F.when(late, F.lit("7")).otherwise(F.lit("7.5")).alias("o_mixed"))
    return profile.inferred_types(cells, list(TYPE_CELLS))


def p_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema section of every table's file, with three documented names."""
    fields = table_fields(spark, sf_dir).withColumn("source", table_name())
    return profile.schema_profile(fields, ["doc_id", "text", "label"])


QUERIES = {
    "p_types": p_types, "p_schema": p_schema, "p_null": p_null, "p_numeric": p_numeric, "p_domain": p_domain, "p_datetime": p_datetime,
    "p_duration": p_duration, "p_reference": p_reference, "p_unmatched": p_unmatched,
    "p_duplicates": p_duplicates, "p_key": p_key, "p_lookup": p_lookup, "p_service": p_service,
    "p_compare": p_compare,
}


def _each(columns: list[str], select: str) -> str:
    return " UNION ALL ".join(select.replace("{c}", c) for c in columns)


def _rate(part: str, whole: str) -> str:
    return f"coalesce({part} / nullif(CAST({whole} AS DOUBLE), 0), 0)"


NULLS = f"""SELECT service_type AS source, '{{c}}' AS "column",
  count(*) FILTER (WHERE {{c}} IS NULL) AS null_count,
  {_rate("count(*) FILTER (WHERE {c} IS NULL)", "count(*)")} AS null_rate FROM trips GROUP BY 1"""


def _numeric(label: str, base: str) -> str:
    points = ", ".join(
        f"round(quantile_cont(CAST({{c}} AS DOUBLE), {p}), 4) AS {n}"
        for n, p in (("p01", .01), ("p50", .5), ("p95", .95), ("p99", .99))
    )
    return f"""SELECT {label} AS source, '{{c}}' AS "column", count({{c}}) AS non_null_count,
      count(*) - count({{c}}) AS null_count, {_rate("(count(*) - count({c}))", "count(*)")} AS null_rate,
      round(CAST(min({{c}}) AS DOUBLE), 4) AS minimum, {points},
      round(CAST(max({{c}}) AS DOUBLE), 4) AS maximum,
      count(*) FILTER (WHERE {{c}} < 0) AS count_lt_0, count(*) FILTER (WHERE {{c}} = 0) AS count_eq_0,
      count(*) FILTER (WHERE {{c}} > 0) AS count_gt_0 FROM {base} GROUP BY 1"""


DOMAIN = """SELECT service_type AS source, '{c}' AS "column", CAST({c} AS VARCHAR) AS "value",
  count(*) AS "count" FROM trips GROUP BY 1, 3"""
DATETIME = f"""SELECT service_type AS source, '{{c}}' AS "column",
  count(*) FILTER (WHERE {{c}} IS NULL) AS null_count,
  {_rate("count(*) FILTER (WHERE {c} IS NULL)", "count(*)")} AS null_rate,
  min({{c}}) AS minimum, max({{c}}) AS maximum FROM trips GROUP BY 1"""
REFERENCE = f"""SELECT service_type AS source, '{{c}}' AS "column", count(*) AS total_rows,
  count(*) - count({{c}}) AS null_count, count({{c}}) AS non_null_count,
  count(location_id) AS matched_count, count({{c}}) - count(location_id) AS unmatched_count,
  {_rate("(count({c}) - count(location_id))", "count({c})")} AS unmatched_rate_among_non_null
  FROM trips LEFT JOIN ({ZONES_SQL}) AS z ON z.location_id = trips.{{c}} GROUP BY 1"""
UNMATCHED = f"""SELECT service_type AS source, '{{c}}' AS "column", CAST({{c}} AS VARCHAR) AS "value",
  count(*) AS "count" FROM trips LEFT JOIN ({ZONES_SQL}) AS z ON z.location_id = trips.{{c}}
  WHERE {{c}} IS NOT NULL AND location_id IS NULL GROUP BY 1, 3"""


def _counts(label: str, base: str, inside: str) -> str:
    return f"""SELECT {label} AS source,
      count(*) FILTER (WHERE dropoff_datetime < pickup_datetime) AS dropoff_before_pickup_count,
      count(*) FILTER (WHERE pickup_datetime IS NULL OR dropoff_datetime IS NULL)
        AS either_datetime_null_count,
      count(*) FILTER (WHERE pickup_datetime IS NOT NULL AND NOT ({inside}))
        AS pickup_outside_nominal_month_count FROM {base} GROUP BY 1"""


def _duplicates(label: str, base: str, columns: str) -> str:
    return f"""SELECT source, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_full_rows,
      CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_participating_in_duplicate_groups,
      CAST(sum(n - 1) AS BIGINT) AS duplicate_excess_rows,
      count(*) FILTER (WHERE n > 1) AS duplicate_groups
      FROM (SELECT {label} AS source, count(*) AS n FROM {base} GROUP BY {label}, {columns}) AS g
      GROUP BY 1"""


def _key(label: str, base: str, column: str) -> str:
    return f"""SELECT source, CAST(sum(n - 1) AS BIGINT) AS duplicate_count, count(k) AS unique_count,
      min(TRY_CAST(k AS DOUBLE)) AS minimum, max(TRY_CAST(k AS DOUBLE)) AS maximum
      FROM (SELECT {label} AS source, {column} AS k, count(*) AS n FROM {base} GROUP BY 1, 2) AS g
      GROUP BY 1"""


def _long(sql: str, section: str, metrics: list[str], text: tuple = (), column: str = '"column"') -> str:
    return " UNION ALL ".join(
        f"""SELECT source, '{section}' AS section, {column} AS "column", '{m}' AS metric,
        {"CAST(NULL AS DOUBLE)" if m in text else f"round(CAST({m} AS DOUBLE), 4)"} AS "number",
        {f"CAST({m} AS VARCHAR)" if m in text else "CAST(NULL AS VARCHAR)"} AS "text"
        FROM ({sql}) AS part""" for m in metrics
    )


def _long_counts(sql: str, section: str) -> str:
    return f"""SELECT source, '{section}' AS section, "column", "value" AS metric,
      CAST("count" AS DOUBLE) AS "number", CAST(NULL AS VARCHAR) AS "text" FROM ({sql}) AS part"""


NUMERIC_METRICS = ["non_null_count", "null_count", "null_rate", *STATS, "count_lt_0", "count_eq_0",
                   "count_gt_0"]
DUPLICATE_METRICS = ["total_rows", "unique_full_rows", "rows_participating_in_duplicate_groups",
                     "duplicate_excess_rows", "duplicate_groups"]
JUNE_1996 = "pickup_datetime >= TIMESTAMP '1996-06-01' AND pickup_datetime < TIMESTAMP '1996-07-01'"
SERVICE_SQL = " UNION ALL ".join([
    _long(_each(NULLABLE, NULLS), "columns", ["null_count", "null_rate"]),
    _long(_each([*NUMERICS, "trip_duration_seconds"], _numeric("service_type", "trips")),
          "numeric", NUMERIC_METRICS),
    _long(_each(CLOCKS, DATETIME), "datetime", ["null_count", "null_rate", "minimum", "maximum"],
          ("minimum", "maximum")),
    _long(_counts("service_type", "trips", JUNE_1996), "duration",
          ["dropoff_before_pickup_count", "either_datetime_null_count",
           "pickup_outside_nominal_month_count"], column="'*'"),
    _long_counts(_each(DOMAINS, DOMAIN), "domain"),
    _long(_each(ROLES, REFERENCE), "reference",
          ["total_rows", "null_count", "non_null_count", "matched_count", "unmatched_count",
           "unmatched_rate_among_non_null"]),
    _long_counts(_each(ROLES, UNMATCHED), "unmatched"),
    _long(_duplicates("service_type", "trips", ", ".join(NULLABLE)), "duplicates",
          DUPLICATE_METRICS, column="'*'"),
])
LOOKUP = """(SELECT c_custkey AS "LocationID", c_mktsegment AS "Borough", c_name AS "Zone",
  CAST(NULL AS VARCHAR) AS service_zone, 'lookup' AS service_type FROM customer) AS trips"""
LOOKUP_SQL = " UNION ALL ".join([
    _long(_each(["LocationID", "Borough", "Zone", "service_zone"],
                NULLS.replace("FROM trips", f"FROM {LOOKUP}")),
          "columns", ["null_count", "null_rate"]),
    _long(_key("'lookup'", "customer", "c_custkey"), "key",
          ["duplicate_count", "unique_count", "minimum", "maximum"], column="'*'"),
    _long_counts(_each(["Borough", "service_zone"], DOMAIN.replace("FROM trips", f"FROM {LOOKUP}")),
                 "domain"),
    _long(_duplicates("'lookup'", "customer", "c_custkey, c_mktsegment, c_name"), "duplicates",
          DUPLICATE_METRICS, column="'*'"),
])
FILES_CTE = f"""WITH trips AS (SELECT *,
  date_diff('microsecond', pickup_datetime, dropoff_datetime) / 1e6 AS trip_duration_seconds
  FROM ({LINES_SQL}) AS l)"""
FILE_LABEL = "CAST(source_file_id AS VARCHAR)"
SAME_MONTH = "year(pickup_datetime) * 100 + month(pickup_datetime) = source_file_id"
TYPE_CELLS = {
    "o_orderkey": "CAST(o_orderkey AS VARCHAR)", "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
    "o_orderstatus": "o_orderstatus",
    "o_clerk_number": "CASE WHEN year(o_orderdate) > 1996 THEN CAST(o_custkey AS VARCHAR) END",
    "o_late": "CAST(year(o_orderdate) > 1996 AS VARCHAR)",
    "o_rare": "CASE WHEN year(o_orderdate) > 1996 THEN 'False' END", "o_nothing": "CAST(NULL AS VARCHAR)",
    "o_mixed": "CASE WHEN year(o_orderdate) > 1996 THEN '7' ELSE '7.5' END",
}
TYPES_SQL = "WITH cells AS (" + " UNION ALL ".join(
    f"""SELECT o_orderstatus AS source, '{c}' AS "column", {e} AS v FROM orders""" for c, e in TYPE_CELLS.items()
) + """), kinds AS (SELECT source, "column", count(*) > count(v) AS nulls, CASE WHEN count(v) = 0 THEN 'null'
  WHEN bool_and(lower(v) IN ('true', 'false')) THEN 'boolean'
  WHEN bool_and(regexp_full_match(v, '[+-]?[0-9]+') AND try_cast(v AS BIGINT) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'int'
  WHEN bool_and(try_cast(v AS DOUBLE) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'double' ELSE 'text' END AS inferred_type
  FROM cells GROUP BY 1, 2)
SELECT source, "column", inferred_type, CASE WHEN inferred_type = 'null' THEN 'double'
  WHEN inferred_type = 'int' AND nulls THEN 'double' WHEN inferred_type = 'boolean' AND nulls THEN 'text'
  ELSE inferred_type END AS read_type FROM kinds"""
SCHEMA_SQL = f"""WITH {FIELDS_CTE}
SELECT table_name AS source, 'schema' AS section, name AS "column", m.metric,
  CASE m.metric WHEN 'ordinal_position' THEN CAST(ordinal_position AS DOUBLE) END AS number,
  CASE m.metric WHEN 'arrow_type' THEN arrow_type WHEN 'nullable' THEN CAST(nullable AS VARCHAR) END AS "text"
FROM fields CROSS JOIN (VALUES ('ordinal_position'), ('arrow_type'), ('nullable')) AS m(metric)
UNION ALL
SELECT t.table_name, 'schema', d.name, 'documented_present', CAST(NULL AS DOUBLE),
  CAST(EXISTS (SELECT 1 FROM fields f WHERE f.table_name = t.table_name AND f.name = d.name) AS VARCHAR)
FROM (SELECT DISTINCT table_name FROM fields) AS t CROSS JOIN (VALUES ('doc_id'), ('text'), ('label')) AS d(name)"""
ORACLE = {
    "p_types": TYPES_SQL,
    "p_schema": SCHEMA_SQL,
    "p_null": f"WITH {TRIPS_CTE} {_each(NULLABLE, NULLS)}",
    "p_numeric": f"WITH {TRIPS_CTE} {_each(NUMERICS, _numeric('service_type', 'trips'))}",
    "p_domain": f"WITH {TRIPS_CTE} {_each(DOMAINS, DOMAIN)}",
    "p_datetime": f"WITH {TRIPS_CTE} {_each(CLOCKS, DATETIME)}",
    "p_duration": f"""{FILES_CTE}
      SELECT n.*, c.dropoff_before_pickup_count, c.either_datetime_null_count,
             c.pickup_outside_nominal_month_count
      FROM ({_each(["trip_duration_seconds"], _numeric(FILE_LABEL, "trips"))}) AS n
      JOIN ({_counts(FILE_LABEL, "trips", SAME_MONTH)}) AS c ON c.source = n.source""",
    "p_reference": f"WITH {TRIPS_CTE} {_each(ROLES, REFERENCE)}",
    "p_unmatched": f"WITH {TRIPS_CTE} {_each(ROLES, UNMATCHED)}",
    "p_duplicates": _duplicates("lang", "documents", "text, documents.source"),
    "p_key": _key("o_orderstatus", "orders", "o_custkey"),
    "p_lookup": LOOKUP_SQL,
    "p_service": f"WITH {TRIPS_CTE} {SERVICE_SQL}",
    "p_compare": f"""WITH {TRIPS_CTE}, p AS ({SERVICE_SQL})
      SELECT section, "column", metric,
        max("number") FILTER (WHERE source = 'line') AS left_number,
        max("number") FILTER (WHERE source = 'order') AS right_number,
        max("text") FILTER (WHERE source = 'line') AS left_text,
        max("text") FILTER (WHERE source = 'order') AS right_text,
        round(max("number") FILTER (WHERE source = 'order')
              - max("number") FILTER (WHERE source = 'line'), 4) AS delta
      FROM p GROUP BY 1, 2, 3""",
}
