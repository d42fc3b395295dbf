"""Quality rules on order lines read as trips, one file per ship month."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.catalog.trips import LINES_SQL, ZONES_SQL, line_trips, table, zones
from fareledger.functions.columns import outside_month
from fareledger.operators import quality
from fareledger.operators.rules import (
    DUPLICATE,
    INFO,
    RATE_CODES,
    WARNING,
    Rule,
    catalog_table,
    domain,
    missing,
    negative,
    reference,
    scalar,
    zero,
)
from fareledger.session import materialize, shared_dir
from fareledger.sources.schemas import CANONICAL, QUALITY_RESULTS
from fareledger.sources.tables import write_partitions

KEY = "source_file_id"
EXECUTED = datetime(2025, 3, 1, tzinfo=UTC)
FLAGS, PAYMENTS = ("N", "R"), (1, 2, 3, 4)
LINE_RULES = [
    scalar("pickup_outside_source_month", WARNING,
           lambda: outside_month("pickup_datetime", "_source_year", "_source_month")),
    scalar("dropoff_before_pickup", WARNING,
           lambda: F.col("dropoff_datetime") < F.col("pickup_datetime")),
    negative("total_amount"),
    zero("tip_amount"),
    missing("tolls_amount", "tolls"),
    domain("unexpected_rate_code", "rate_code_id", RATE_CODES),
    domain("unexpected_flag", "store_and_fwd_flag", FLAGS),
    domain("unexpected_payment_type", "payment_type", PAYMENTS),
    reference("unknown_pickup_zone", "pickup_location_id"),
    reference("unknown_dropoff_zone", "dropoff_location_id"),
    Rule("exact_duplicate_source_rows", WARNING, DUPLICATE),
]
LINEAGE = ("source_file_id", "source_row_number", "pipeline_run_id", "ingested_at")
WIDTH = ("source_row_number", "pipeline_run_id", "ingested_at")  # lineage that no rule looks at
SOURCE_COLUMNS = [c for c in CANONICAL.names if c not in LINEAGE]


def checked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_trips(spark, sf_dir).select(
        "*", F.floor(F.col(KEY) / 100).alias("_source_year"),
        F.pmod(F.col(KEY), F.lit(100)).alias("_source_month"),
    )


def q_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scalar_checks(checked_rows(spark, sf_dir), LINE_RULES, [KEY])


def q_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_counts(checked_rows(spark, sf_dir), LINE_RULES, [KEY])


def q_domain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_rows(spark, sf_dir)
    targets = rows.groupBy(KEY).agg(F.first(KEY).alias("run_id"))
    return quality.quality_values(quality.domain_counts(rows, LINE_RULES, [KEY]), targets, KEY)


def q_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_checks(checked_rows(spark, sf_dir), LINE_RULES, [KEY])


def q_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reference_checks(
        checked_rows(spark, sf_dir), LINE_RULES, zones(spark, sf_dir), "location_id", [KEY]
    )


def q_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.exact_duplicates(
        table(spark, sf_dir, "documents"), ["text", "lang", "source"]
    )


def q_duplicates_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.exact_duplicates_prefiltered(table(spark, sf_dir, "lineitem"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each kind of rule scans the rows: they are joined once and stored.
    rows = materialize(checked_rows(spark, sf_dir).drop(*WIDTH))
    measures = quality.measure(
        rows, LINE_RULES, [KEY], zones(spark, sf_dir), "location_id", SOURCE_COLUMNS, prefilter=True
    )
    targets = rows.groupBy(KEY).agg(F.first(KEY).alias("run_id"))
    return quality.quality_results(measures, LINE_RULES, targets, KEY, EXECUTED)


def q_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).drop("executed_at")


def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results stored twice by run: the second write replaces, ids stay."""
    path = f"{shared_dir(spark)}/results-{uuid.uuid4().hex}"
    results = materialize(_results(spark, sf_dir))
    stale = results.where(F.col("run_id") <= 199612).withColumn("rows_failed", F.lit(-1).cast("long"))
    write_partitions(stale.hint("rebalance", F.col("run_id")), path, "run_id")
    write_partitions(results.hint("rebalance", F.col("run_id")), path, "run_id")
    return spark.read.schema(QUALITY_RESULTS).parquet(path).drop("executed_at")


def q_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violation_counters(_results(spark, sf_dir))


def q_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_overview(_results(spark, sf_dir))


def q_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.results_by_severity(_results(spark, sf_dir))


def q_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violated_warnings(_results(spark, sf_dir))


def q_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the line catalog with the rows their column is filled in."""
    filled = line_trips(spark, sf_dir).agg(*[
        F.count(rule.column).alias(rule.name) for rule in LINE_RULES if rule.column
    ])
    counts = filled.unpivot([], filled.columns, "check_name", "filled_rows")
    return catalog_table(spark, LINE_RULES).join(counts, "check_name", "left").select(
        "ordinal", "check_name", "severity", "kind", "filled_rows"
    )


QUERIES = {
    "q_scalar": q_scalar, "q_domain_counts": q_domain_counts, "q_domain": q_domain,
    "q_domain_values": q_domain_values,
    "q_reference": q_reference, "q_duplicates": q_duplicates,
    "q_duplicates_wide": q_duplicates_wide, "q_results": q_results, "q_upsert": q_upsert,
    "q_counters": q_counters, "q_overview": q_overview, "q_severity": q_severity,
    "q_warnings": q_warnings, "q_catalog": q_catalog,
}

CONDITIONS = {
    "pickup_outside_source_month": """pickup_datetime IS NOT NULL AND
      (year(pickup_datetime) * 100 + month(pickup_datetime)) <> source_file_id""",
    "dropoff_before_pickup": "dropoff_datetime < pickup_datetime",
    "negative_total_amount": "total_amount < 0",
    "zero_tip_amount": "tip_amount = 0",
    "tolls_null_rate": "tolls_amount IS NULL",
}
SCALAR_SQL = " UNION ALL ".join(
    f"""SELECT source_file_id, count(*) AS rows_checked, '{name}' AS check_name,
    count(*) FILTER (WHERE {condition}) AS rows_failed FROM t GROUP BY 1"""
    for name, condition in CONDITIONS.items()
)
T_CTE = f"t AS ({LINES_SQL})"
DOMAIN_COUNTS_SQL = f"""
SELECT source_file_id, 'unexpected_rate_code' AS check_name, rate_code_id AS int_value,
       CAST(NULL AS VARCHAR) AS text_value, count(*) AS "count"
FROM t WHERE rate_code_id NOT IN {RATE_CODES} GROUP BY 1, 3
UNION ALL
SELECT source_file_id, 'unexpected_flag', NULL, store_and_fwd_flag, count(*)
FROM t WHERE store_and_fwd_flag NOT IN {FLAGS} GROUP BY 1, 4
UNION ALL
SELECT source_file_id, 'unexpected_payment_type', payment_type, NULL, count(*)
FROM t WHERE payment_type NOT IN {PAYMENTS} GROUP BY 1, 3
"""
DOMAIN_SQL = f"""
SELECT source_file_id, check_name, CAST(sum("count") AS BIGINT) AS rows_failed,
       '{{"unexpected_value_count":' || CAST(count(*) AS VARCHAR) || '}}' AS details
FROM ({DOMAIN_COUNTS_SQL}) AS c GROUP BY 1, 2
"""
REFERENCE_SQL = " UNION ALL ".join(
    f"""SELECT source_file_id, '{name}' AS check_name, count(*) AS rows_failed
    FROM t LEFT JOIN ({ZONES_SQL}) AS z ON z.location_id = t.{column}
    WHERE t.{column} IS NOT NULL AND z.location_id IS NULL GROUP BY 1"""
    for name, column in (("unknown_pickup_zone", "pickup_location_id"),
                         ("unknown_dropoff_zone", "dropoff_location_id"))
)
DUPLICATE_SQL = f"""
SELECT source_file_id, 'exact_duplicate_source_rows' AS check_name,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_failed,
       '{{"duplicate_excess_rows":' || CAST(coalesce(sum(n - 1), 0) AS VARCHAR)
       || ',"duplicate_groups":' || CAST(count(*) FILTER (WHERE n > 1) AS VARCHAR) || '}}' AS details
FROM (SELECT source_file_id, count(*) AS n FROM t
      GROUP BY source_file_id, {", ".join(SOURCE_COLUMNS)}) AS g GROUP BY 1
"""
CATALOG_SQL = ", ".join(
    f"({i}, '{r.name}', '{r.severity}', '{r.kind}')" for i, r in enumerate(LINE_RULES, 1)
)
RESULTS_SQL = f"""
WITH {T_CTE},
files AS (SELECT source_file_id, count(*) AS n FROM t GROUP BY 1),
rules AS (SELECT * FROM (VALUES {CATALOG_SQL}) AS r(ordinal, check_name, severity, kind)),
m AS (
  SELECT source_file_id, check_name, rows_failed, CAST(NULL AS VARCHAR) AS details FROM ({SCALAR_SQL}) AS s
  UNION ALL SELECT source_file_id, check_name, rows_failed, details FROM ({DOMAIN_SQL}) AS d
  UNION ALL SELECT source_file_id, check_name, rows_failed, NULL FROM ({REFERENCE_SQL}) AS r
  UNION ALL SELECT source_file_id, check_name, rows_failed, details FROM ({DUPLICATE_SQL}) AS u
),
results AS (
  SELECT f.source_file_id * 1000 + r.ordinal AS quality_result_id, f.source_file_id AS run_id,
         r.check_name, r.severity,
         CASE WHEN coalesce(m.rows_failed, 0) = 0 THEN 'passed' ELSE 'violated' END AS status,
         f.n AS rows_checked, coalesce(m.rows_failed, 0) AS rows_failed,
         coalesce(m.rows_failed, 0) / CAST(f.n AS DOUBLE) AS failure_rate,
         coalesce(m.details, CASE WHEN r.kind = 'domain' THEN '{{"unexpected_value_count":0}}' END) AS details
  FROM files f JOIN rules r ON true
  LEFT JOIN m ON m.source_file_id = f.source_file_id AND m.check_name = r.check_name
)
"""
ORACLE = {
    "q_scalar": f"WITH {T_CTE} {SCALAR_SQL}",
    "q_domain_counts": f"WITH {T_CTE} {DOMAIN_COUNTS_SQL}",
    "q_domain_values": f"""WITH {T_CTE} SELECT source_file_id AS run_id, check_name, int_value,
      text_value, "count" FROM ({DOMAIN_COUNTS_SQL}) AS c""",
    "q_domain": f"WITH {T_CTE} {DOMAIN_SQL}",
    "q_reference": f"WITH {T_CTE} {REFERENCE_SQL}",
    "q_duplicates": """SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS participating_rows,
      CAST(sum(n - 1) AS BIGINT) AS excess_rows, count(*) FILTER (WHERE n > 1) AS duplicate_groups,
      CAST(sum(n) AS BIGINT) AS total_rows
      FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source) AS g""",
    "q_duplicates_wide": """SELECT CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS participating_rows,
      CAST(sum(n - 1) AS BIGINT) AS excess_rows, count(*) FILTER (WHERE n > 1) AS duplicate_groups,
      CAST(sum(n) AS BIGINT) AS total_rows
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey,
        l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
        l_shipdate) AS g""",
    "q_results": f"{RESULTS_SQL} SELECT * FROM results",
    "q_upsert": f"{RESULTS_SQL} SELECT * FROM results",
    "q_counters": f"""{RESULTS_SQL} SELECT run_id, CAST(count(*) AS INTEGER) AS check_count,
      CAST(count(*) FILTER (WHERE status = 'violated' AND severity = 'WARNING') AS INTEGER) AS warning_count,
      CAST(count(*) FILTER (WHERE status = 'violated' AND severity = 'ERROR') AS INTEGER) AS error_count
      FROM results GROUP BY 1""",
    "q_overview": f"""{RESULTS_SQL} SELECT count(*) AS checks_run,
      count(*) FILTER (WHERE status = 'violated' AND severity = 'WARNING') AS warnings_violated,
      count(*) FILTER (WHERE status = 'violated' AND severity = 'ERROR') AS errors_violated,
      count(*) FILTER (WHERE severity = '{INFO}') AS info_metrics FROM results""",
    "q_severity": f"{RESULTS_SQL} SELECT severity, count(*) AS results FROM results GROUP BY 1",
    "q_warnings": f"""{RESULTS_SQL} SELECT run_id, check_name, rows_failed FROM results
      WHERE severity = 'WARNING' AND status = 'violated'""",
    "q_catalog": f"""WITH {T_CTE}, c AS (SELECT {", ".join(
        f"count({r.column}) AS {r.name}" for r in LINE_RULES if r.column)} FROM t)
      SELECT CAST(ordinal AS INTEGER) AS ordinal, check_name, severity, kind,
        CASE check_name {" ".join(f"WHEN '{r.name}' THEN (SELECT {r.name} FROM c)"
                                  for r in LINE_RULES if r.column)} END AS filled_rows
      FROM (VALUES {CATALOG_SQL}) AS r(ordinal, check_name, severity, kind)""",
}
