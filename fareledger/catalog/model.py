"""Canonical trips, star schema, model checks and analytics on the order tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.catalog import trips as source
from fareledger.catalog.trips import STAR_SQL, TRIPS_CTE, served, table
from fareledger.functions.ranks import median_by, nearest_rank_percentile
from fareledger.operators import checks
from fareledger.plans import analytics, rollup, star, statistics
from fareledger.plans.build import fact_builder
from fareledger.session import shared_dir
from fareledger.sources.tables import Warehouse

WIDTH = ["source_row_number", "ingested_at"]


def canonical_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.trips(spark, sf_dir).drop(*WIDTH)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.enrich(source.trips(spark, sf_dir)).select(
        "service_type", "source_file_id", "pickup_date", "dropoff_date", "trip_duration_seconds"
    )


def observed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.observed_dates(star.enrich(source.trips(spark, sf_dir)))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(star.enrich(source.trips(spark, sf_dir)))


def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_zone(source.zones(spark, sf_dir))


def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_vendor(source.vendors(spark, sf_dir))


def fact_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = fact_builder(*source.dimensions(spark, sf_dir))
    return build(star.enrich(source.trips(spark, sf_dir))).drop("source_row_number")


def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the first ship year, then of all other files of both services, then nothing new."""
    warehouse = Warehouse(spark, f"{shared_dir(spark)}/incremental-{uuid.uuid4().hex}")
    raw, registry = source.raw_trips(spark, sf_dir, warehouse)
    build = fact_builder(*source.dimensions(spark, sf_dir, raw))
    first_year = registry.where(F.col("source_file_id") <= 199512)
    for known in (first_year, registry, registry):
        trips = star.arriving(raw, known, warehouse)
        if trips is not None:
            star.incremental_fact(star.enrich(trips), warehouse, build, only_new=True)
    return warehouse.read(star.FACT_TABLE).withColumn(
        "source_file_id", F.col("source_file_id").cast("bigint")).drop("source_row_number")


def loaded_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of finished orders, with orders as the registry of their lines."""
    registry = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("source_file_id"), F.lit("orders").alias("dataset_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("loaded")).otherwise("ready").alias("status"),
    )
    return star.loaded_only(table(spark, sf_dir, "lineitem"), registry, "orders", key="l_orderkey")


def rounded(df: DataFrame) -> DataFrame:
    """Double aggregates at a precision that does not depend on the order of additions.

    Sums keep cents. Averages keep seven places, where exact halves are out of reach.
    """
    return df.select(*[
        F.round(f.name, 2 if "total" in f.name else 7).alias(f.name)
        if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


BOUNDS = {"start": date(1996, 1, 1), "end": date(1996, 3, 31)}


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dates, _, _, partials, _ = served(spark, sf_dir)
    return rounded(rollup.summary(partials, dates))


def fact_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged statistics of the stored facts; estimates are left out, as SQL has no such sketch."""
    stored = statistics.refresh(source.served_warehouse(spark, sf_dir))
    return statistics.merged(stored).drop("distinct_estimate")


def summary_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dates, _, _, partials, _ = served(spark, sf_dir)
    return rounded(rollup.summary(partials, dates, service_type="line", **BOUNDS))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dates, _, _, partials, _ = served(spark, sf_dir)
    return rounded(rollup.monthly(partials, dates))


def monthly_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dates, _, _, partials, _ = served(spark, sf_dir)
    return rounded(rollup.monthly(partials, dates, end=date(1997, 6, 30)))


def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dates, zones, _, partials, _ = served(spark, sf_dir)
    return rounded(rollup.top_zones(partials, dates, zones))


def top_zones_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dates, zones, _, partials, _ = served(spark, sf_dir)
    return rounded(rollup.top_zones(partials, dates, zones, 5, service_type="line", **BOUNDS))


def summary_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered summary from facts, opening only files whose range meets the dates."""
    facts, dates, _, _, _, ranges = served(spark, sf_dir)
    return rounded(analytics.summary(facts, dates, service_type="line", ranges=ranges, **BOUNDS))


def rollup_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = served(spark, sf_dir)[4]
    return partials.select(*[
        F.round(f.name, 7).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in partials.schema.fields])


def file_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return served(spark, sf_dir)[5]


def t_unique_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship months that hold several lines of one order, with the order as row number."""
    lines = table(spark, sf_dir, "lineitem").select(
        source.year_month("l_shipdate").alias("source_file_id"), F.col("l_orderkey").alias("source_row_number"))
    return checks.unique_lineage(lines)


def monthly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.monthly_pivot(
        monthly(spark, sf_dir), "total_amount", ["line", "order"]
    ))


def monthly_pivot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.monthly_pivot(
        monthly(spark, sf_dir), "average_fare_amount", ["line", "order"], "mean"
    ))


def service_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.service_share(monthly(spark, sf_dir)))


def zone_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.zone_labels(top_zones(spark, sf_dir)).select("label", "trip_count")


def lineage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.lineage_counts(source.line_trips(spark, sf_dir))


def nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_rank_percentile(
        table(spark, sf_dir, "orders"), "o_totalprice", 0.95, ["o_orderpriority"]
    )


def median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(median_by(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"]))


# Model checks. Inputs are chosen so that most of them find something.


def t_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null(source.trips(spark, sf_dir), "vendor_id").select(
        "service_type", "source_file_id", "fare_amount"
    )


def t_not_null_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null_many(
        source.trips(spark, sf_dir), ["vendor_id", "pickup_datetime", "dropoff_datetime", "tolls_amount"]
    )


def t_relationships_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone_dim = dim_zone(spark, sf_dir)
    return checks.relationships_many(source.trips(spark, sf_dir), {
        "pickup_location_id": (zone_dim, "zone_key"), "dropoff_location_id": (zone_dim, "zone_key"),
        "vendor_id": (dim_vendor(spark, sf_dir), "vendor_key"),
    })


def t_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "documents"), "text")


def t_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def t_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    builders = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return checks.relationships(table(spark, sf_dir, "orders"), "o_custkey", builders, "c_custkey")


def t_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.accepted_values(table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "N"])


def t_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    return checks.grain_match(lines, orders, "order_key", ("line_rows", "order_rows"))


def t_grain_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_key")
    )
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "order_key")
    return checks.grain_match_left(
        finished, lines, lines.where("l_linestatus = 'F'"), "order_key"
    )


def t_count_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.count_equal(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def t_exactly_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.exactly_one(table(spark, sf_dir, "nation"), F.col("n_regionkey") == 1, "nations")


def t_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension is whole; a vendor list without its Unknown member is reported."""
    return checks.unknown_members({
        "dim_zone": (dim_zone(spark, sf_dir), F.col("zone_key") == 0),
        "vendors": (source.vendors(spark, sf_dir), F.col("vendor_name") == "Unknown"),
    })


QUERIES = {
    "canonical_union": canonical_union, "enriched": enriched, "observed_dates": observed_dates,
    "dim_date": dim_date, "dim_zone": dim_zone, "dim_vendor": dim_vendor,
    "fact_star": fact_star, "fact_incremental": fact_incremental, "loaded_only": loaded_only,
    "summary": summary, "summary_filtered": summary_filtered, "monthly": monthly,
    "monthly_filtered": monthly_filtered, "top_zones": top_zones,
    "top_zones_filtered": top_zones_filtered, "summary_facts": summary_facts,
    "rollup_partials": rollup_partials, "file_ranges": file_ranges, "fact_statistics": fact_statistics,
    "monthly_pivot": monthly_pivot,
    "monthly_pivot_mean": monthly_pivot_mean, "service_share": service_share,
    "zone_labels": zone_labels, "lineage_counts": lineage_counts, "nearest_rank": nearest_rank,
    "median_by": median, "t_not_null": t_not_null,
    "t_not_null_many": t_not_null_many, "t_relationships_many": t_relationships_many,
    "t_unique": t_unique,
    "t_unique_key": t_unique_key, "t_unique_lineage": t_unique_lineage, "t_relationships": t_relationships, "t_accepted": t_accepted,
    "t_grain": t_grain, "t_grain_left": t_grain_left, "t_count_equal": t_count_equal,
    "t_exactly_one": t_exactly_one, "t_unknown": t_unknown,
}

FACTS = "FROM facts f JOIN dates d ON d.date_key = f.pickup_date_key"
Q1_1996 = "d.full_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'"
MEASURES_SQL = """count(*) AS trip_count, round(sum(f.total_amount), 2) AS total_amount,
  round(avg(f.trip_distance_miles), 7) AS average_trip_distance_miles,
  round(avg(f.fare_amount), 7) AS average_fare_amount,
  round(avg(f.tip_amount), 7) AS average_tip_amount"""


def _monthly_sql(where: str = "") -> str:
    return f"""{STAR_SQL} SELECT CAST(date_trunc('month', d.full_date) AS DATE) AS "month",
      f.service_type, {MEASURES_SQL} {FACTS} {where} GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2"""


def _zones_sql(where: str = "", limit: int = 10) -> str:
    return f"""{STAR_SQL} SELECT z.location_id, z.borough, z.zone_name, count(*) AS trip_count,
      round(sum(f.total_amount), 2) AS total_amount
      {FACTS} JOIN dim_zone z ON z.zone_key = f.pickup_zone_key {where}
      GROUP BY z.zone_key, z.location_id, z.borough, z.zone_name
      ORDER BY count(*) DESC, z.zone_key LIMIT {limit}"""


def _pivot_sql(measure: str, how: str) -> str:
    cells = ", ".join(
        f"round({how}(CASE WHEN service_type = '{s}' THEN {measure} END), 7) AS \"{s}\""
        for s in ("line", "order")
    )
    return f"""SELECT coalesce(CAST("month" AS VARCHAR), 'Unknown') AS "month", {cells}
      FROM ({_monthly_sql()}) AS m GROUP BY 1"""


ORACLE = {
    "canonical_union": f"{source.LINES_SQL} UNION ALL {source.ORDERS_SQL}",
    "enriched": f"WITH {TRIPS_CTE} SELECT service_type, source_file_id, pickup_date, dropoff_date, trip_duration_seconds FROM trips",
    "observed_dates": f"WITH {TRIPS_CTE}, {source.DATES_CTE} SELECT full_date FROM dates WHERE full_date IS NOT NULL",
    "dim_date": f"WITH {TRIPS_CTE}, {source.DATES_CTE} SELECT * FROM dates",
    "dim_zone": f"WITH {source.ZONE_DIM_CTE} SELECT * FROM dim_zone",
    "dim_vendor": f"WITH {source.VENDOR_DIM_CTE} SELECT * FROM dim_vendor",
    "fact_star": f"{STAR_SQL} SELECT * FROM facts",
    "fact_incremental": f"{STAR_SQL} SELECT * FROM facts",
    "loaded_only": """SELECT l.* FROM lineitem l
      WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "summary": f"{STAR_SQL} SELECT {MEASURES_SQL} {FACTS}",
    "summary_filtered": f"{STAR_SQL} SELECT {MEASURES_SQL} {FACTS} WHERE f.service_type = 'line' AND {Q1_1996}",
    "summary_facts": f"{STAR_SQL} SELECT {MEASURES_SQL} {FACTS} WHERE f.service_type = 'line' AND {Q1_1996}",
    "rollup_partials": f"""{STAR_SQL} SELECT source_file_id, pickup_date_key, service_type, pickup_zone_key,
      count(*) AS trip_count, """ + ", ".join(
        f"round(sum({c}), 7) AS sum_{c}, count({c}) AS count_{c}" for c in rollup.SUMMED)
      + " FROM facts GROUP BY 1, 2, 3, 4",
    "file_ranges": f"""{STAR_SQL} SELECT source_file_id,
      min(pickup_date_key) FILTER (pickup_date_key > 0) AS min_date_key,
      max(pickup_date_key) FILTER (pickup_date_key > 0) AS max_date_key,
      count(*) AS row_count, count(*) FILTER (pickup_date_key = 0) AS unknown_count FROM facts GROUP BY 1""",
    "monthly": _monthly_sql(),
    "monthly_filtered": _monthly_sql("WHERE d.full_date <= DATE '1997-06-30'"),
    "top_zones": _zones_sql(),
    "top_zones_filtered": _zones_sql(f"WHERE f.service_type = 'line' AND {Q1_1996}", 5),
    "monthly_pivot": _pivot_sql("total_amount", "sum"),
    "monthly_pivot_mean": _pivot_sql("average_fare_amount", "avg"),
    "service_share": f"""SELECT service_type, CAST(sum(trip_count) AS BIGINT) AS trip_count,
      round(sum(trip_count) / sum(sum(trip_count)) OVER (), 7) AS "share"
      FROM ({_monthly_sql()}) AS m GROUP BY 1""",
    "fact_statistics": STAR_SQL + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
        CAST({f"min({c})" if c in statistics.KEYS else "NULL"} AS BIGINT) AS min_key,
        CAST({f"max({c})" if c in statistics.KEYS else "NULL"} AS BIGINT) AS max_key,
        CAST({f"min({c})" if c in statistics.TEXTS else "NULL"} AS VARCHAR) AS min_text,
        CAST({f"max({c})" if c in statistics.TEXTS else "NULL"} AS VARCHAR) AS max_text FROM facts"""
        for c in statistics.KEYS + statistics.TEXTS
    ),
    "zone_labels": f"SELECT borough || ' · ' || zone_name AS label, trip_count FROM ({_zones_sql()}) AS z",
    "lineage_counts": "SELECT count(*) AS row_count, count(*) AS lineage_count FROM lineitem",
    "nearest_rank": """SELECT o_orderpriority,
      quantile_disc(o_totalprice, 0.95) AS percentile FROM orders GROUP BY 1""",
    "median_by": """SELECT l_returnflag, round(median(l_extendedprice), 7) AS median
      FROM lineitem GROUP BY 1""",
    "t_not_null": f"WITH {TRIPS_CTE} SELECT service_type, source_file_id, fare_amount FROM trips WHERE vendor_id IS NULL",
    "t_not_null_many": f"WITH {TRIPS_CTE} SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS row_count FROM trips"
        for c in ("vendor_id", "pickup_datetime", "dropoff_datetime", "tolls_amount")
    ) + ") AS n WHERE row_count > 0",
    "t_relationships_many": f"WITH {TRIPS_CTE}, {source.ZONE_DIM_CTE}, {source.VENDOR_DIM_CTE} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS "value", count(*) AS row_count
        FROM trips WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {d}) GROUP BY {c}"""
        for c, d, k in (("pickup_location_id", "dim_zone", "zone_key"),
                        ("dropoff_location_id", "dim_zone", "zone_key"),
                        ("vendor_id", "dim_vendor", "vendor_key"))
    ),
    "t_unique": "SELECT text, count(*) AS row_count FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "t_unique_key": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "t_unique_lineage": """SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS source_file_id,
      count(*) AS row_count, count(DISTINCT l_orderkey) AS lineage_count FROM lineitem
      GROUP BY 1 HAVING count(*) <> count(DISTINCT l_orderkey)""",
    "t_relationships": """SELECT o_custkey, count(*) AS row_count FROM orders
      WHERE o_custkey IS NOT NULL AND o_custkey NOT IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""",
    "t_accepted": "SELECT l_returnflag, count(*) AS row_count FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 1",
    "t_grain": """WITH a AS (SELECT l_orderkey AS order_key, count(*) AS line_rows FROM lineitem GROUP BY 1),
      b AS (SELECT o_orderkey AS order_key, count(*) AS order_rows FROM orders GROUP BY 1)
      SELECT coalesce(a.order_key, b.order_key) AS order_key, line_rows, order_rows
      FROM a FULL OUTER JOIN b ON a.order_key = b.order_key
      WHERE line_rows IS DISTINCT FROM order_rows""",
    "t_grain_left": """WITH e AS (SELECT o_orderkey AS order_key FROM orders WHERE o_orderstatus = 'F'),
      a AS (SELECT l_orderkey AS order_key, count(*) AS n FROM lineitem GROUP BY 1),
      b AS (SELECT l_orderkey AS order_key, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
      SELECT e.order_key, coalesce(a.n, 0) AS raw_row_count, coalesce(b.n, 0) AS staging_row_count
      FROM e LEFT JOIN a USING (order_key) LEFT JOIN b USING (order_key)
      WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
    "t_count_equal": """SELECT * FROM (SELECT (SELECT count(*) FROM orders) AS left_rows,
      (SELECT count(*) FROM lineitem) AS right_rows) AS c WHERE left_rows <> right_rows""",
    "t_exactly_one": "SELECT * FROM (SELECT count(*) FILTER (WHERE n_regionkey = 1) AS nations FROM nation) AS n WHERE nations <> 1",
    "t_unknown": f"""WITH {source.ZONE_DIM_CTE}
      SELECT 'dim_zone' AS dimension_name WHERE (SELECT count(*) FROM dim_zone WHERE zone_key = 0) <> 1
      UNION ALL
      SELECT 'vendors' WHERE (SELECT count(*) FROM ({source.VENDORS_SQL}) AS v WHERE vendor_name = 'Unknown') <> 1""",
}
