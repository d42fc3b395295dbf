"""Staging, canonical trips and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.functions.columns import date_key, melt, seconds_between
from fareledger.session import materialize, small_splits
from fareledger.sources.manifest import list_files
from fareledger.sources.readers import align_columns
from fareledger.sources.schemas import CANONICAL, LOADED, ZONE_PARTITION
from fareledger.sources.tables import Warehouse, write_partitions

# Canonical names of the shared source columns.
SHARED = {
    "VendorID": "vendor_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance_miles",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra_amount",
    "mta_tax": "mta_tax_amount",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge_amount",
    "congestion_surcharge": "congestion_surcharge_amount",
    "cbd_congestion_fee": "cbd_congestion_fee_amount",
    "total_amount": "total_amount",
    "_source_file_id": "source_file_id",
    "_source_row_number": "source_row_number",
    "_pipeline_run_id": "pipeline_run_id",
    "_ingested_at": "ingested_at",
}
FACT_MEASURES = (
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "cbd_congestion_fee_amount", "total_amount",
)
FACT_TABLE = "marts/fct_trips"


def loaded_only(
    raw: DataFrame, registry: DataFrame, dataset: str, service: str | None = None,
    partition: str | None = None, key: str = "_source_file_id",
) -> DataFrame:
    """Raw rows of loaded versions; on a table partitioned by file this prunes partitions."""
    chosen = registry.where((F.col("dataset_name") == dataset) & (F.col("status") == LOADED))
    if service is not None:
        chosen = chosen.where(F.col("service_type") == service)
    if partition is not None:
        chosen = chosen.where(F.col("partition_key") == partition)
    return raw.join(chosen.select(F.col("source_file_id").alias(key)), key, "left_semi")


def to_canonical(raw: DataFrame, service: str, renames: dict[str, str]) -> DataFrame:
    """Raw columns under canonical names; what the service lacks is a typed null."""
    renamed = raw.select(
        F.lit(service).alias("service_type"),
        *[F.col(f"`{c}`").alias(renames[c]) for c in raw.columns if c in renames],
    )
    return align_columns(renamed, CANONICAL)


def stage_yellow(raw: DataFrame, registry: DataFrame) -> DataFrame:
    names = SHARED | {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        "Airport_fee": "airport_fee_amount",
    }
    return to_canonical(loaded_only(raw, registry, "yellow_tripdata", "yellow"), "yellow", names)


def stage_green(raw: DataFrame, registry: DataFrame) -> DataFrame:
    names = SHARED | {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
        "trip_type": "trip_type",
    }
    return to_canonical(loaded_only(raw, registry, "green_tripdata", "green"), "green", names)


def stage_zones(raw: DataFrame, registry: DataFrame) -> DataFrame:
    loaded = loaded_only(raw, registry, "taxi_zone_lookup", partition=ZONE_PARTITION)
    return loaded.select(
        F.col("LocationID").alias("location_id"), F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"), "service_zone",
        F.col("_source_file_id").alias("source_file_id"),
        F.col("_source_row_number").alias("source_row_number"),
        F.col("_pipeline_run_id").alias("pipeline_run_id"),
        F.col("_ingested_at").alias("ingested_at"),
    )


def normalize(*services: DataFrame) -> DataFrame:
    """All services stacked on the canonical columns, copies kept."""
    rows = services[0].select(*CANONICAL.names)
    for other in services[1:]:
        rows = rows.unionByName(other.select(*CANONICAL.names))
    return rows


def enrich(trips: DataFrame) -> DataFrame:
    return trips.select(
        "*",
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.to_date("dropoff_datetime").alias("dropoff_date"),
        seconds_between("pickup_datetime", "dropoff_datetime").alias("trip_duration_seconds"),
    )


def observed_dates(trips: DataFrame) -> DataFrame:
    """Distinct non-null pickup and dropoff dates from a single scan."""
    days = {name: F.col(name) for name in ("pickup_date", "dropoff_date")}
    return melt(trips, [], days, "role", "full_date").select("full_date").distinct()


def dim_date(trips: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """One row per observed date plus the key-0 Unknown member.

    ``earlier`` is the dimension of trips that need not be read again.
    """
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    days = observed_dates(trips)
    if earlier is not None:
        days = days.unionByName(earlier.select("full_date").where(day.isNotNull())).distinct()
    known = days.select(
        date_key(day).alias("date_key"), "full_date",
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.day(day).alias("day"),
        weekday.cast("int").alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    )
    unknown = trips.sparkSession.range(1).select(*[
        (F.lit(0) if f.name == "date_key" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in known.schema.fields
    ])
    return unknown.unionAll(known)


def dim_zone(zones: DataFrame) -> DataFrame:
    known = zones.select(
        F.col("location_id").alias("zone_key"), "location_id", "borough", "zone_name",
        "service_zone",
    )
    unknown = zones.sparkSession.range(1).select(
        F.lit(0).alias("zone_key"), F.lit(None).cast("int").alias("location_id"),
        F.lit("Unknown").alias("borough"), F.lit("Unknown").alias("zone_name"),
        F.lit(None).cast("string").alias("service_zone"),
    )
    return unknown.unionAll(known)


def dim_vendor(vendors: DataFrame) -> DataFrame:
    known = vendors.select(F.col("vendor_id").alias("vendor_key"), "vendor_id", "vendor_name")
    unknown = vendors.sparkSession.range(1).select(
        F.lit(0).alias("vendor_key"), F.lit(None).cast("int").alias("vendor_id"),
        F.lit("Unknown").alias("vendor_name"),
    )
    return unknown.unionAll(known)


def _lookup(rows: DataFrame, dim: DataFrame, code: str, dim_code: str, take: str, name: str) -> DataFrame:
    """Left join of one attribute by natural key.

    There is no broadcast hint: Catalyst broadcasts a stored dimension while its files are
    under the threshold. Beyond that the join shuffles, and adaptive execution splits the
    partitions of hot and of null codes.
    """
    attribute = dim.where(F.col(dim_code).isNotNull()).select(
        F.col(dim_code).alias(f"_{name}_code"), F.col(take).alias(name)
    )
    return rows.join(attribute, F.col(code) == F.col(f"_{name}_code"), "left")


def build_fact(
    trips: DataFrame, dates: DataFrame, zones: DataFrame, vendors: DataFrame,
    rate_codes: DataFrame, payments: DataFrame,
) -> DataFrame:
    """Enriched trips with surrogate keys; unresolved codes get key 0 or the name Unknown."""
    rows = _lookup(trips, dates, "pickup_date", "full_date", "date_key", "pickup_date_key")
    rows = _lookup(rows, dates, "dropoff_date", "full_date", "date_key", "dropoff_date_key")
    rows = _lookup(rows, zones, "pickup_location_id", "location_id", "zone_key", "pickup_zone_key")
    rows = _lookup(rows, zones, "dropoff_location_id", "location_id", "zone_key", "dropoff_zone_key")
    rows = _lookup(rows, vendors, "vendor_id", "vendor_id", "vendor_key", "vendor_key")
    rows = _lookup(rows, rate_codes, "rate_code_id", "rate_code_id", "rate_code_name",
                   "rate_code_name")
    rows = _lookup(rows, payments, "payment_type", "payment_type", "payment_type_name",
                   "payment_type_name")
    keys = ["pickup_date_key", "dropoff_date_key", "pickup_zone_key", "dropoff_zone_key",
            "vendor_key"]
    return rows.select(
        "service_type",
        *[F.coalesce(k, F.lit(0)).alias(k) for k in keys],
        "pickup_datetime", "dropoff_datetime", "trip_duration_seconds", "passenger_count",
        "trip_distance_miles", "rate_code_id",
        F.coalesce("rate_code_name", F.lit("Unknown")).alias("rate_code_name"),
        "payment_type",
        F.coalesce("payment_type_name", F.lit("Unknown")).alias("payment_type_name"),
        "trip_type", *FACT_MEASURES, "source_file_id", "source_row_number", "pipeline_run_id",
    )


def new_sources(registry: DataFrame, present: DataFrame) -> DataFrame:
    """Registered versions that a table does not hold yet; no trip is read to find them.

    An anti join of trips with the ids they are stored under would scan all history. Staging
    this remainder of the registry instead prunes the raw partitions by its semi join.
    """
    return registry.join(present.select("source_file_id").distinct(), "source_file_id", "left_anti")


def new_files(trips: DataFrame, present: DataFrame) -> DataFrame:
    """Trips of files that the fact table does not hold yet."""
    return trips.join(present.select("source_file_id").distinct(), "source_file_id", "left_anti")


def stored_files(warehouse: Warehouse, table: str = FACT_TABLE) -> DataFrame:
    """File ids the table holds, from its partition folders; no rows are read."""
    listed = list_files(warehouse.spark, warehouse.path(table))
    return listed.select(
        F.regexp_extract("path", r"source_file_id=(\d+)", 1).cast("bigint").alias("source_file_id")
    ).distinct()


def pending(files: DataFrame) -> DataFrame:
    """File ids as a small stored table behind a filter.

    The optimizer prunes partitions by a join only where the other side is filtered.
    """
    marked = materialize(files.select("source_file_id", F.lit(1).alias("pending")).distinct())
    return marked.where("pending = 1").select("source_file_id")


def arriving(
    raw: DataFrame, registry: DataFrame, warehouse: Warehouse, table: str = FACT_TABLE
) -> DataFrame | None:
    """Rows of the registered files that the fact table lacks, or None where it lacks none.

    What is missing is told from the registry and the table's partition folders; ``raw`` is
    partitioned by file, so the semi join opens the missing files' partitions only.
    """
    if warehouse.exists(table):
        registry = new_sources(registry, stored_files(warehouse, table))
    fresh = pending(registry)
    if fresh.isEmpty():
        return None
    return raw.join(fresh, "source_file_id", "left_semi")


def incremental_fact(
    trips: DataFrame, warehouse: Warehouse, build, full_refresh: bool = False,
    table: str = FACT_TABLE, rebalance: bool = False, only_new: bool = False,
) -> DataFrame:
    """Add the facts of new files, or rebuild all of them.

    ``only_new`` says that ``trips`` are those of new files already: ``arriving``, or staged from
    ``new_sources``. Without it known files are anti-joined away, which reads all of ``trips``.

    ``build`` turns enriched trips into facts. The table is partitioned by file, so known
    ids are a partition listing and writing touches only new partitions. Rows are sorted
    inside each partition by date key and service for row-group skipping. Raw tables are
    laid out by file already; ``rebalance`` gathers the rows of each file first where the
    input is not, and adaptive execution splits a file that holds too many of them.
    """
    path = warehouse.path(table)
    rebuild = full_refresh or not warehouse.exists(table)
    if not rebuild and not only_new:
        trips = new_files(trips, stored_files(warehouse, table))
    facts = build(trips)
    if rebalance:
        facts = facts.hint("rebalance", F.col("source_file_id"))
    facts = cluster_fact(facts)
    # A sorted fact takes some fifteen times its stored size: full splits would spill.
    with small_splits(warehouse.spark):
        if rebuild:
            facts.write.mode("overwrite").partitionBy("source_file_id").parquet(path)
        else:
            write_partitions(facts, path, "source_file_id")
    # The stated schema keeps the column types even if a build had nothing to add.
    return warehouse.read(table, facts.schema)


def cluster_fact(facts: DataFrame) -> DataFrame:
    return facts.sortWithinPartitions("source_file_id", "pickup_date_key", "service_type")


def analyze_fact(spark: SparkSession, warehouse: Warehouse, table: str = FACT_TABLE,
                 name: str = "fct_trips") -> None:
    """Register the stored fact table and collect the statistics the optimizer uses."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{warehouse.path(table)}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.sql(
        f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS pickup_date_key, pickup_zone_key, "
        "vendor_key, service_type"
    )
