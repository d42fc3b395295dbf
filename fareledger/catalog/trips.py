"""Order tables read as trips of two services, in Spark and as the equal SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.plans import rollup, star
from fareledger.plans.build import fact_builder
from fareledger.session import materialize, shared_dir, spread
from fareledger.sources.readers import align_columns
from fareledger.sources.schemas import CANONICAL
from fareledger.sources.seeds import SEEDS
from fareledger.sources.tables import Warehouse, write_partitions

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year_month(column: str) -> F.Column:
    return (F.year(column) * 100 + F.month(column)).cast("bigint")


def raw_trips(spark: SparkSession, sf_dir: str, warehouse: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Trips of both services stored by file, as raw tables are, and their registry."""
    rows = trips(spark, sf_dir, by_file=True)
    write_partitions(rows, warehouse.path("raw/trips"), "source_file_id")
    return warehouse.read("raw/trips", rows.schema), star.stored_files(warehouse, "raw/trips")


def location(nation: str, balance: str) -> F.Column:
    """The nation's zone, or a code that no zone has where the account is overdrawn."""
    return F.when(F.col(balance) < 0, F.col(nation) + 901).otherwise(F.col(nation) + 1)


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nation and balance of their customer."""
    orders = table(spark, sf_dir, "orders").select(
        "*", (F.col("_metadata.row_index") + 1).alias("_row")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")


def gathered(rows: DataFrame, file_id: Column, by_file: bool) -> DataFrame:
    """Rows with their ``_file``; those of each file together if asked for.

    Done on the joined columns, before trips are made of them: a trip is twice as wide.
    """
    rows = rows.withColumn("_file", file_id)
    return rows.hint("rebalance", F.col("_file")) if by_file else rows


def line_trips(spark: SparkSession, sf_dir: str, by_file: bool = False) -> DataFrame:
    """Order lines as trips from order date to ship date; the ship month is the file."""
    lines = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_linenumber", "l_returnflag",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        (F.col("_metadata.row_index") + 1).alias("_row"),
    ))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    # Customers meet the few columns of orders, not the lines: these are shuffled by order only.
    placed = customer_orders(spark, sf_dir).select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "c_nationkey", "c_acctbal")
    joined = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    joined = gathered(joined, year_month("l_shipdate"), by_file)
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return align_columns(joined.select(
        F.lit("line").alias("service_type"),
        F.when(F.col("s_acctbal") < 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey")).alias("vendor_id"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_quantity").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance_miles"),
        F.col("l_linenumber").alias("rate_code_id"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        location("c_nationkey", "c_acctbal").alias("pickup_location_id"),
        location("s_nationkey", "s_acctbal").alias("dropoff_location_id"),
        F.substring("o_orderpriority", 1, 1).alias("payment_type"),
        price.alias("fare_amount"),
        discount.alias("extra_amount"),
        F.col("l_tax").alias("mta_tax_amount"),
        (price * discount).alias("tip_amount"),
        (price * (1 - discount) * (1 + F.col("l_tax"))).alias("total_amount"),
        F.col("_file").alias("source_file_id"),
        F.col("_row").alias("source_row_number"),
        F.col("_file").alias("pipeline_run_id"),
    ), CANONICAL)


def order_trips(spark: SparkSession, sf_dir: str, by_file: bool = False) -> DataFrame:
    """Orders as trips that lack every column only lines have."""
    joined = gathered(customer_orders(spark, sf_dir), year_month("o_orderdate") + 1_000_000, by_file)
    return align_columns(joined.select(
        F.lit("order").alias("service_type"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("o_orderstatus").alias("store_and_fwd_flag"),
        location("c_nationkey", "c_acctbal").alias("pickup_location_id"),
        F.substring("o_orderpriority", 1, 1).alias("payment_type"),
        F.lit(1).alias("trip_type"),
        F.col("o_totalprice").alias("fare_amount"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("_file").alias("source_file_id"),
        F.col("_row").alias("source_row_number"),
        F.col("_file").alias("pipeline_run_id"),
    ), CANONICAL)


def trips(spark: SparkSession, sf_dir: str, by_file: bool = False) -> DataFrame:
    return star.normalize(line_trips(spark, sf_dir, by_file), order_trips(spark, sf_dir, by_file))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones; trips of overdrawn accounts carry codes beyond them."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("n_nationkey") + 1).alias("location_id"), F.col("r_name").alias("borough"),
            F.col("n_name").alias("zone_name"), F.lit("Nation").alias("service_zone"),
        )
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as vendors; lines of overdrawn suppliers carry a code that none has."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("vendor_id"), F.col("s_name").alias("vendor_name")
    )


def dimensions(
    spark: SparkSession, sf_dir: str, raw: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored dimensions: the date one needs a scan, of stored trips if given, and all get a known size."""
    enriched = star.enrich(trips(spark, sf_dir) if raw is None else raw)
    return (
        materialize(star.dim_date(enriched)),
        materialize(star.dim_zone(zones(spark, sf_dir))),
        materialize(star.dim_vendor(vendors(spark, sf_dir))),
    )


_STORED: dict[tuple, tuple] = {}
_WAREHOUSES: dict[tuple, Warehouse] = {}
INPUTS = ("nation", "region", "customer", "supplier", "orders", "lineitem")


def identity(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, lengths and times of change of the input files: other data is another star."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for name in INPUTS:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        for file in path.getFileSystem(conf).listStatus(path):
            seen.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(seen))


def served(spark: SparkSession, sf_dir: str) -> tuple:
    """The warehouse's stored tables: facts, dates, zones, vendors, rollup and file ranges.

    Served queries read what a build has stored; a session builds once for each state of the files.
    """
    key = (spark.sparkContext.applicationId, identity(spark, sf_dir))
    if key not in _STORED:
        dates, zone_dim, vendor_dim = dimensions(spark, sf_dir)
        name = f"star-{spark.sparkContext.applicationId}-{len(_STORED)}"
        warehouse = Warehouse(spark, f"{shared_dir(spark)}/{name}")
        facts = star.incremental_fact(
            star.enrich(trips(spark, sf_dir, by_file=True)), warehouse,
            fact_builder(dates, zone_dim, vendor_dim), full_refresh=True,
        )
        _WAREHOUSES[key] = warehouse
        _STORED[key] = (facts, dates, zone_dim, vendor_dim, *rollup.refresh(warehouse, True))
    return _STORED[key]


def served_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse that holds the stored star."""
    served(spark, sf_dir)
    return _WAREHOUSES[spark.sparkContext.applicationId, identity(spark, sf_dir)]


def stored_star(spark: SparkSession, sf_dir: str) -> tuple:
    """Facts, dates, zones and vendors as stored tables."""
    return served(spark, sf_dir)[:4]


def values_sql(name: str) -> str:
    """A seed as an SQL relation."""
    ddl, rows = SEEDS[name]
    columns = ", ".join(part.split()[0] for part in ddl.split(", "))
    cells = ", ".join(f"({code}, '{text}')" for code, text in rows)
    return f"(VALUES {cells}) AS seed({columns})"


ZONES_SQL = """
SELECT n_nationkey + 1 AS location_id, r_name AS borough, n_name AS zone_name,
       'Nation' AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""
VENDORS_SQL = "SELECT CAST(s_suppkey AS INTEGER) AS vendor_id, s_name AS vendor_name FROM supplier"
LINES_SQL = """
SELECT 'line' AS service_type, CAST(CASE WHEN s_acctbal < 0 THEN -l_suppkey ELSE l_suppkey END AS INTEGER) AS vendor_id,
       o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
       CAST(l_quantity AS BIGINT) AS passenger_count, l_quantity AS trip_distance_miles,
       CAST(l_linenumber AS BIGINT) AS rate_code_id, l_returnflag AS store_and_fwd_flag,
       CASE WHEN c_acctbal < 0 THEN c_nationkey + 901 ELSE c_nationkey + 1 END AS pickup_location_id, CASE WHEN s_acctbal < 0 THEN s_nationkey + 901 ELSE s_nationkey + 1 END AS dropoff_location_id,
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
       CAST(NULL AS BIGINT) AS trip_type,
       l_extendedprice AS fare_amount, l_discount AS extra_amount, l_tax AS mta_tax_amount,
       l_extendedprice * l_discount AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount,
       CAST(NULL AS DOUBLE) AS improvement_surcharge_amount,
       CAST(NULL AS DOUBLE) AS congestion_surcharge_amount,
       CAST(NULL AS DOUBLE) AS airport_fee_amount, CAST(NULL AS DOUBLE) AS cbd_congestion_fee_amount,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
       CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS source_file_id,
       CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS pipeline_run_id
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
"""
ORDERS_SQL = """
SELECT 'order' AS service_type, CAST(NULL AS INTEGER) AS vendor_id,
       o_orderdate AS pickup_datetime, CAST(NULL AS TIMESTAMP) AS dropoff_datetime,
       CAST(NULL AS BIGINT) AS passenger_count, CAST(NULL AS DOUBLE) AS trip_distance_miles,
       CAST(NULL AS BIGINT) AS rate_code_id, o_orderstatus AS store_and_fwd_flag,
       CASE WHEN c_acctbal < 0 THEN c_nationkey + 901 ELSE c_nationkey + 1 END AS pickup_location_id, CAST(NULL AS INTEGER) AS dropoff_location_id,
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
       CAST(1 AS BIGINT) AS trip_type,
       o_totalprice AS fare_amount, CAST(NULL AS DOUBLE) AS extra_amount,
       CAST(NULL AS DOUBLE) AS mta_tax_amount, CAST(NULL AS DOUBLE) AS tip_amount,
       CAST(NULL AS DOUBLE) AS tolls_amount,
       CAST(NULL AS DOUBLE) AS improvement_surcharge_amount,
       CAST(NULL AS DOUBLE) AS congestion_surcharge_amount,
       CAST(NULL AS DOUBLE) AS airport_fee_amount, CAST(NULL AS DOUBLE) AS cbd_congestion_fee_amount,
       o_totalprice AS total_amount,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) + 1000000 AS BIGINT) AS source_file_id,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) + 1000000 AS BIGINT) AS pipeline_run_id
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""
TRIPS_CTE = f"""
trips AS (
  SELECT *, CAST(pickup_datetime AS DATE) AS pickup_date,
         CAST(dropoff_datetime AS DATE) AS dropoff_date,
         date_diff('microsecond', pickup_datetime, dropoff_datetime) / 1e6 AS trip_duration_seconds
  FROM ({LINES_SQL} UNION ALL {ORDERS_SQL}) AS stacked
)"""
DATES_CTE = """
dates AS (
  SELECT 0 AS date_key, CAST(NULL AS DATE) AS full_date, CAST(NULL AS INTEGER) AS "year",
         CAST(NULL AS INTEGER) AS "quarter", CAST(NULL AS INTEGER) AS "month",
         CAST(NULL AS VARCHAR) AS month_name, CAST(NULL AS INTEGER) AS "day",
         CAST(NULL AS INTEGER) AS day_of_week, CAST(NULL AS VARCHAR) AS day_name,
         CAST(NULL AS BOOLEAN) AS is_weekend
  UNION ALL
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER), d, CAST(year(d) AS INTEGER),
         CAST(quarter(d) AS INTEGER), CAST(month(d) AS INTEGER), monthname(d),
         CAST(day(d) AS INTEGER), CAST(isodow(d) AS INTEGER), dayname(d), isodow(d) IN (6, 7)
  FROM (SELECT pickup_date AS d FROM trips WHERE pickup_date IS NOT NULL
        UNION SELECT dropoff_date FROM trips WHERE dropoff_date IS NOT NULL) AS observed
)"""
ZONE_DIM_CTE = f"""
dim_zone AS (
  SELECT 0 AS zone_key, CAST(NULL AS INTEGER) AS location_id, 'Unknown' AS borough,
         'Unknown' AS zone_name, CAST(NULL AS VARCHAR) AS service_zone
  UNION ALL
  SELECT location_id, location_id, borough, zone_name, service_zone FROM ({ZONES_SQL}) AS z
)"""
VENDOR_DIM_CTE = f"""
dim_vendor AS (
  SELECT 0 AS vendor_key, CAST(NULL AS INTEGER) AS vendor_id, 'Unknown' AS vendor_name
  UNION ALL SELECT vendor_id, vendor_id, vendor_name FROM ({VENDORS_SQL}) AS v
)"""
FACT_COLUMNS_SQL = """
  t.service_type, coalesce(pd.date_key, 0) AS pickup_date_key,
  coalesce(dd.date_key, 0) AS dropoff_date_key, coalesce(pz.zone_key, 0) AS pickup_zone_key,
  coalesce(dz.zone_key, 0) AS dropoff_zone_key, coalesce(v.vendor_key, 0) AS vendor_key,
  t.pickup_datetime, t.dropoff_datetime, t.trip_duration_seconds, t.passenger_count,
  t.trip_distance_miles, t.rate_code_id, coalesce(r.rate_code_name, 'Unknown') AS rate_code_name,
  t.payment_type, coalesce(p.payment_type_name, 'Unknown') AS payment_type_name, t.trip_type,
  t.fare_amount, t.extra_amount, t.mta_tax_amount, t.tip_amount, t.tolls_amount,
  t.improvement_surcharge_amount, t.congestion_surcharge_amount, t.airport_fee_amount,
  t.cbd_congestion_fee_amount, t.total_amount, t.source_file_id, t.pipeline_run_id
"""
FACT_CTE = f"""
facts AS (
  SELECT {FACT_COLUMNS_SQL}
  FROM trips t
  LEFT JOIN dates pd ON t.pickup_date = pd.full_date
  LEFT JOIN dates dd ON t.dropoff_date = dd.full_date
  LEFT JOIN dim_zone pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN dim_zone dz ON t.dropoff_location_id = dz.location_id
  LEFT JOIN dim_vendor v ON t.vendor_id = v.vendor_id
  LEFT JOIN (SELECT * FROM {values_sql("rate_codes")}) r ON t.rate_code_id = r.rate_code_id
  LEFT JOIN (SELECT * FROM {values_sql("payment_types")}) p ON t.payment_type = p.payment_type
)"""
STAR_SQL = f"WITH {TRIPS_CTE}, {DATES_CTE}, {ZONE_DIM_CTE}, {VENDOR_DIM_CTE}, {FACT_CTE}"
