"""Build every model in dependency order and test it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareledger.operators import checks
from fareledger.operators.registry import raise_if_any
from fareledger.plans import rollup, star, statistics
from fareledger.plans.ingest import registry_state
from fareledger.session import materialize
from fareledger.sources.schemas import LOADED, ZONE_PARTITION
from fareledger.sources.seeds import read_seed
from fareledger.sources.tables import Warehouse, write_view


@dataclass(frozen=True)
class Models:
    """The built relations: views for staging and trips, stored tables for the marts."""

    registry: DataFrame
    yellow: DataFrame
    green: DataFrame
    zones: DataFrame
    trips: DataFrame
    dates: DataFrame
    dim_zone: DataFrame
    dim_vendor: DataFrame
    facts: DataFrame
    rollup: DataFrame
    ranges: DataFrame
    column_statistics: DataFrame


def fact_builder(dates: DataFrame, zones: DataFrame, vendors: DataFrame):
    """``build_fact`` bound to its dimensions and seeds."""
    spark = dates.sparkSession
    rates, payments = read_seed(spark, "rate_codes"), read_seed(spark, "payment_types")
    return lambda trips: star.build_fact(trips, dates, zones, vendors, rates, payments)


def dimension_tests(dates: DataFrame, zones: DataFrame, vendors: DataFrame) -> dict[str, DataFrame]:
    """Checks that must hold before facts are joined: a repeated key would multiply trips."""
    tests = {}
    for name, df, key in (("dim_date", dates, "date_key"), ("dim_zone", zones, "zone_key"),
                          ("dim_vendor", vendors, "vendor_key")):
        tests[f"not_null_{name}_{key}"] = checks.not_null(df, key)
        tests[f"unique_{name}_{key}"] = checks.unique(df, key)
    tests["unique_dim_zone_location_id"] = checks.unique(zones, "location_id")
    tests["dimensions_unknown_members"] = checks.unknown_members({
        "dim_zone": (zones, (F.col("zone_key") == 0) & F.col("location_id").isNull()
                     & (F.col("borough") == "Unknown") & (F.col("zone_name") == "Unknown")),
        "dim_vendor": (vendors, (F.col("vendor_key") == 0) & F.col("vendor_id").isNull()
                       & (F.col("vendor_name") == "Unknown")),
        "dim_date": (dates, (F.col("date_key") == 0) & F.col("full_date").isNull()),
    })
    return tests


def model_tests(models: Models, warehouse: Warehouse) -> dict[str, DataFrame]:
    """All model checks by name."""
    tests = dimension_tests(models.dates, models.dim_zone, models.dim_vendor)
    facts = models.facts
    parents = {
        "pickup_zone_key": (models.dim_zone, "zone_key"),
        "dropoff_zone_key": (models.dim_zone, "zone_key"),
        "vendor_key": (models.dim_vendor, "vendor_key"),
        "pickup_date_key": (models.dates, "date_key"),
        "dropoff_date_key": (models.dates, "date_key"),
    }
    lineage = ["source_file_id", "source_row_number"]
    tests["not_null_fct_trips"] = checks.not_null_many(
        facts, [*parents, *lineage, "pipeline_run_id"]
    )
    tests["relationships_fct_trips"] = checks.relationships_many(facts, parents)
    for name, df in (("fct_trips", facts), ("int_trips", models.trips),
                     ("stg_yellow", models.yellow), ("stg_green", models.green)):
        tests[f"{name}_lineage_unique"] = checks.unique_lineage(df, *lineage)
    for name, df in (("stg_yellow", models.yellow), ("stg_green", models.green)):
        tests[f"not_null_{name}"] = checks.not_null_many(
            df, ["service_type", *lineage, "pipeline_run_id", "ingested_at"]
        )
    tests["accepted_values_int_trips_service_type"] = checks.accepted_values(
        models.trips, "service_type", ["yellow", "green"]
    )
    tests["fct_trips_source_grain"] = checks.grain_match(
        models.trips, facts, "source_file_id", ("canonical_row_count", "fact_row_count")
    )

    def loaded(dataset: str) -> DataFrame:
        return models.registry.where(
            (F.col("dataset_name") == dataset) & (F.col("status") == LOADED)
        )

    def raw(dataset: str) -> DataFrame:
        rows = warehouse.raw(dataset).withColumnRenamed("_source_file_id", "source_file_id")
        return rows.join(loaded(dataset).select("source_file_id"), "source_file_id", "left_semi")

    tests["stg_yellow_loaded_grain"] = checks.grain_match_left(
        loaded("yellow_tripdata"), raw("yellow_tripdata"), models.yellow, "source_file_id"
    )
    tests["stg_green_loaded_grain"] = checks.grain_match(
        raw("green_tripdata"), models.green, "source_file_id",
        ("raw_row_count", "staging_row_count"),
    )
    tests["not_null_stg_zones_location_id"] = checks.not_null(models.zones, "location_id")
    tests["unique_stg_zones_location_id"] = checks.unique(models.zones, "location_id")
    tests["stg_zones_active_grain"] = checks.count_equal(raw("taxi_zone_lookup"), models.zones)
    tests["stg_zones_one_loaded_source"] = checks.exactly_one(
        models.registry,
        (F.col("partition_key") == ZONE_PARTITION) & (F.col("status") == LOADED)
        & (F.col("dataset_name") == "taxi_zone_lookup"),
        "source_count",
    )
    return tests


def violations_per_test(tests: dict[str, DataFrame]) -> DataFrame:
    """Violating rows per test."""
    return reduce(DataFrame.unionAll, [
        df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("test_name"), "violations")
        for name, df in tests.items()
    ])


def _require(tests: dict[str, DataFrame]) -> None:
    raise_if_any(violations_per_test(tests).where("violations > 0").select(
        F.format_string("Model test %s found %d violations", "test_name", "violations")
        .alias("problem")
    ))


def build_all(warehouse: Warehouse, full_refresh: bool = False) -> Models:
    """Staging, canonical trips, dimensions, facts: each tested before the next uses it.

    A later build reads the raw partitions of new file versions only, and none if there are none.
    """
    spark, registry = warehouse.spark, registry_state(warehouse)
    yellow = write_view(star.stage_yellow(warehouse.raw("yellow_tripdata"), registry), "stg_yellow")
    green = write_view(star.stage_green(warehouse.raw("green_tripdata"), registry), "stg_green")
    zones = write_view(star.stage_zones(warehouse.raw("taxi_zone_lookup"), registry), "stg_zones")
    trips = write_view(star.enrich(star.normalize(yellow, green)), "int_trips_enriched")

    dim_zone = warehouse.write_table(star.dim_zone(zones), "marts/dim_zone")
    dim_vendor = warehouse.write_table(
        star.dim_vendor(read_seed(spark, "vendors")), "marts/dim_vendor"
    )
    rebuild = full_refresh or not warehouse.exists(star.FACT_TABLE)
    if rebuild:
        arriving, dates = trips, star.dim_date(trips)
    else:
        fresh = materialize(star.new_sources(registry, star.stored_files(warehouse)))
        dates, facts = warehouse.read("marts/dim_date"), warehouse.read(star.FACT_TABLE)
        if fresh.where((F.col("status") == LOADED) & F.col("service_type").isNotNull()).isEmpty():
            _require(dimension_tests(dates, dim_zone, dim_vendor))
            return Models(registry, yellow, green, zones, trips, dates, dim_zone, dim_vendor, facts,
                          *rollup.refresh(warehouse), statistics.refresh(warehouse))
        arriving = star.enrich(star.normalize(
            star.stage_yellow(warehouse.raw("yellow_tripdata"), fresh),
            star.stage_green(warehouse.raw("green_tripdata"), fresh),
        ))
        dates = materialize(star.dim_date(arriving, dates))
    dates = warehouse.write_table(dates, "marts/dim_date")
    _require(dimension_tests(dates, dim_zone, dim_vendor))
    facts = star.incremental_fact(
        arriving, warehouse, fact_builder(dates, dim_zone, dim_vendor), full_refresh, only_new=True
    )
    return Models(registry, yellow, green, zones, trips, dates, dim_zone, dim_vendor, facts,
                  *rollup.refresh(warehouse, rebuild), statistics.refresh(warehouse, rebuild))


def build_and_test(warehouse: Warehouse, full_refresh: bool = False) -> Models:
    models = build_all(warehouse, full_refresh)
    _require(model_tests(models, warehouse))
    return models
