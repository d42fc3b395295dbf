"""Scans and staging over raw files that the queries write from the order tables themselves."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.catalog.raw_rules import FILE, KEY, SERVICES, columns, raw_rows
from fareledger.catalog.trips import table
from fareledger.plans import star
from fareledger.session import shared_dir
from fareledger.sources.manifest import list_files
from fareledger.sources.readers import align_columns, read_trips, read_zones
from fareledger.sources.schemas import CANONICAL, LOADED, READY, ZONES, ZONE_PARTITION
from fareledger.sources.tables import Warehouse

# Versions of later months have arrived, but are not loaded yet.
LAST_LOADED = 199606


def warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, f"{shared_dir(spark)}/staging-{uuid.uuid4().hex}")


def raw_table(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """The service's raw table, one partition per month of order."""
    rows = raw_rows(spark, sf_dir, service).withColumns({
        "_source_row_number": F.lit(1).cast("bigint"), "_pipeline_run_id": F.col(KEY) + 1})
    store = warehouse(spark)
    store.append_raw(align_columns(rows, SERVICES[service][0].raw_schema), f"{service}_tripdata")
    return store.raw(f"{service}_tripdata")


def registry(raw: DataFrame, service: str) -> DataFrame:
    return raw.select(F.col(KEY).alias("source_file_id")).distinct().select(
        "source_file_id", F.lit(f"{service}_tripdata").alias("dataset_name"),
        F.lit(service).alias("service_type"), F.lit(None).cast("string").alias("partition_key"),
        F.when(F.col("source_file_id") <= LAST_LOADED, F.lit(LOADED)).otherwise(READY).alias("status"),
    )


def stage_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_table(spark, sf_dir, "yellow")
    return star.stage_yellow(raw, registry(raw, "yellow")).drop("ingested_at")


def stage_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_table(spark, sf_dir, "green")
    return star.stage_green(raw, registry(raw, "green")).drop("ingested_at")


def _zone_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as lookup files, one for each region."""
    path = f"{shared_dir(spark)}/zones-{uuid.uuid4().hex}"
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nations.select(
        F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit("Nation")).alias("service_zone"),
    ).write.partitionBy("region").option("header", True).csv(path)
    files = list_files(spark, path, "*.csv").collect()
    return read_zones(spark, [row[0] for row in files])


def read_zone_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_files(spark, sf_dir).select(*ZONES.names)


def stage_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones staged from the one loaded version among two."""
    rows = _zone_files(spark, sf_dir).withColumn("_source_file_id", F.explode(F.array(
        F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))))
    store = warehouse(spark)
    store.append_raw(align_columns(rows, ZONES.raw_schema), "taxi_zone_lookup")
    versions = store.raw("taxi_zone_lookup").select(F.col("_source_file_id").alias("source_file_id")).distinct()
    known = versions.select(
        "source_file_id", F.lit("taxi_zone_lookup").alias("dataset_name"),
        F.lit(None).cast("string").alias("service_type"), F.lit(ZONE_PARTITION).alias("partition_key"),
        F.when(F.col("source_file_id") == 2, F.lit(LOADED)).otherwise(READY).alias("status"))
    return star.stage_zones(store.raw("taxi_zone_lookup"), known).select(
        "location_id", "borough", "zone_name", "service_zone", "source_file_id")


def read_trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip files of the first layout, read with the later one: the added column is null."""
    contract = SERVICES["yellow"][0]
    path = f"{shared_dir(spark)}/trips-{uuid.uuid4().hex}"
    rows = raw_rows(spark, sf_dir, "yellow").select(*[name for name, _ in contract.baseline])
    rows.write.parquet(path)
    files = [row[0] for row in list_files(spark, path).collect()]
    return read_trips(spark, files, contract).select(*contract.names)


QUERIES = {
    "read_trips": read_trip_files, "read_zones": read_zone_files, "stage_yellow": stage_yellow,
    "stage_green": stage_green, "stage_zones": stage_zones,
}

SQL_TYPES = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "bigint": "BIGINT", "int": "INTEGER",
             "double": "DOUBLE"}
LINES = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 7) AS l"
JOINED = f"""{LINES} JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"""


def staged_sql(service: str) -> str:
    prefix = SERVICES[service][1]
    named = star.SHARED | {
        f"{prefix}_pickup_datetime": "pickup_datetime", f"{prefix}_dropoff_datetime": "dropoff_datetime",
        "Airport_fee": "airport_fee_amount", "trip_type": "trip_type"}
    source = {named[raw]: sql for raw, sql in columns(service).items() if raw in named}
    source |= {"service_type": f"'{service}'", "source_file_id": FILE, "source_row_number": "CAST(1 AS BIGINT)",
               "pipeline_run_id": f"{FILE} + 1"}
    chosen = ", ".join(
        f"CAST({source.get(f.name, 'NULL')} AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in CANONICAL.fields if f.name != "ingested_at")
    return f"SELECT {chosen} FROM {JOINED} WHERE {FILE} <= {LAST_LOADED}"


def trips_sql() -> str:
    contract = SERVICES["yellow"][0]
    first = {name for name, _ in contract.baseline}
    chosen = ", ".join(
        f"{columns('yellow')[n] if n in first else 'CAST(NULL AS DOUBLE)'} AS {n}" for n in contract.names)
    return f"SELECT {chosen} FROM {JOINED}"


ZONE_SQL = """n_nationkey AS {0}, r_name AS {1}, n_name AS {2},
CASE WHEN n_nationkey % 2 = 0 THEN 'Nation' ELSE '' END AS service_zone"""
NATIONS = "FROM nation JOIN region ON n_regionkey = r_regionkey"
ORACLE = {
    "read_trips": trips_sql(),
    "read_zones": f"SELECT {ZONE_SQL.format('LocationID', 'Borough', 'Zone')} {NATIONS}",
    "stage_yellow": staged_sql("yellow"),
    "stage_green": staged_sql("green"),
    "stage_zones": f"""SELECT {ZONE_SQL.format('location_id', 'borough', 'zone_name')},
      CAST(2 AS BIGINT) AS source_file_id {NATIONS}""",
}
