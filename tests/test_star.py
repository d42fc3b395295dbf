from pyspark.sql import functions as F

from fareledger.operators import checks
from fareledger.plans import star
from fareledger.plans.build import build_all, fact_builder
from fareledger.plans.ingest import ingest_batch
from fareledger.session import literal_table, materialize
from fareledger.sources.landing import trip_source, zone_source
from fareledger.sources.readers import align_columns
from fareledger.sources.schemas import CANONICAL, YELLOW
from fareledger.sources.seeds import read_seed
from tests.conftest import YELLOW_LATER, YELLOW_ROWS, at, rows, write_rows


def trips(spark, listed):
    df = literal_table(
        spark, listed,
        "source_file_id bigint, source_row_number bigint, pickup_datetime timestamp_ntz, "
        "dropoff_datetime timestamp_ntz, vendor_id int, pickup_location_id int",
    )
    return star.enrich(align_columns(df, CANONICAL))


def test_dim_date_members(spark):
    df = trips(spark, [
        (1, 1, at("2025-01-05 23:59"), at("2025-01-06 00:01"), 1, 1),
        (1, 2, at("2025-01-05 10:00"), None, 1, 1), (1, 3, None, at("2024-12-31 09:00"), 1, 1),
    ])
    got = {r["date_key"]: r for r in rows(star.dim_date(df))}
    assert set(got) == {0, 20250105, 20250106, 20241231}
    sunday = got[20250105]
    assert (sunday["day_of_week"], sunday["day_name"], sunday["is_weekend"]) == (7, "Sunday", True)
    assert (sunday["month_name"], sunday["quarter"], sunday["day"]) == ("January", 1, 5)
    assert set(got[0].values()) == {0, None}


def test_duration_keeps_sign_and_microseconds(spark):
    df = trips(spark, [(1, 1, at("2025-01-05 10:00"), at("2025-01-05 09:58:59.500000"), 1, 1)])
    assert rows(df)[0]["trip_duration_seconds"] == -60.5


def members(spark, df):
    zones = literal_table(spark, [(1, "Manhattan", "Alpha", "Yellow Zone")],
                          "location_id int, borough string, zone_name string, service_zone string")
    return (materialize(star.dim_date(df)), materialize(star.dim_zone(zones)),
            materialize(star.dim_vendor(read_seed(spark, "vendors"))))


def test_incremental_adds_only_new_files_and_keeps_stale_keys(spark, warehouse):
    first = trips(spark, [(1, 1, at("2025-01-05 10:00"), None, 3, 7)])
    dates, zones, vendors = members(spark, first)
    facts = star.incremental_fact(first, warehouse, fact_builder(dates, zones, vendors))
    assert rows(facts.select("vendor_key", "pickup_zone_key")) == [{"vendor_key": 0, "pickup_zone_key": 0}]

    wider = zones.unionByName(literal_table(
        spark, [(7, 7, "Queens", "Gamma", None)],
        "zone_key int, location_id int, borough string, zone_name string, service_zone string"))
    both = first.unionByName(trips(spark, [(2, 1, at("2025-01-05 10:00"), None, 1, 7)]))
    build = fact_builder(dates, wider, vendors)
    facts = star.incremental_fact(both, warehouse, build)
    keys = {r["source_file_id"]: r["pickup_zone_key"] for r in rows(facts)}
    assert keys == {1: 0, 2: 7}  # an old file keeps the key it was given
    assert rows(star.incremental_fact(both, warehouse, build)) == rows(facts)
    fresh = star.incremental_fact(both, warehouse, build, full_refresh=True)
    assert {r["source_file_id"]: r["pickup_zone_key"] for r in rows(fresh)} == {1: 7, 2: 7}

    gone = both.where("source_file_id = 2")  # a file that is no longer loaded
    stale = rows(checks.grain_match(gone, star.incremental_fact(gone, warehouse, build), "source_file_id"))
    assert stale == [{"source_file_id": 1, "left_rows": None, "right_rows": 1}]


def test_unloaded_files_stay_out_of_staging(spark, warehouse, landing):
    root = str(landing)
    ingest_batch(warehouse, [zone_source(root), trip_source("yellow", 2025, 1, root)])
    # Rows of a version without a succeeded run, as a lost load would leave them.
    orphan = warehouse.raw("yellow_tripdata").withColumn("_source_file_id", F.lit(99).cast("bigint"))
    warehouse.append_raw(materialize(orphan), "yellow_tripdata")
    assert warehouse.raw("yellow_tripdata").count() == 6
    models = build_all(warehouse)
    assert {r["source_file_id"] for r in rows(models.facts)} == {2}
    assert models.facts.count() == 3


def test_analyze_registers_statistics(spark, warehouse, landing):
    root = str(landing)
    write_rows(landing / "data/landing/yellow/2025/02.parquet", YELLOW.fields, YELLOW_LATER)
    ingest_batch(warehouse, [zone_source(root), trip_source("yellow", 2025, 1, root),
                             trip_source("yellow", 2025, 2, root)])
    models = build_all(warehouse)
    star.analyze_fact(spark, warehouse, name="fct_check")
    try:
        assert spark.table("fct_check").count() == len(YELLOW_ROWS) + len(YELLOW_LATER)
        facts = spark.sql("DESCRIBE EXTENDED fct_check pickup_date_key").collect()
        assert {r["info_name"]: r["info_value"] for r in facts}["max"] == "20250217"
    finally:
        spark.sql("DROP TABLE fct_check")
    assert models.facts.count() == 5


def test_arriving_opens_new_files_only(spark, warehouse):
    from fareledger.plans.build import fact_builder
    from fareledger.sources.tables import write_partitions
    listed = [(f, n, at(f"2025-01-0{f} 08:00"), at("2025-01-09 09:00"), 1, 1) for f in (1, 2, 3) for n in (1, 2)]
    rows_in = trips(spark, listed).select(*CANONICAL.names)
    write_partitions(rows_in, warehouse.path("raw/trips"), "source_file_id")
    raw = warehouse.read("raw/trips", rows_in.schema)
    registry = star.stored_files(warehouse, "raw/trips")
    whole = star.enrich(raw)
    build = fact_builder(star.dim_date(whole), star.dim_zone(literal_table(
        spark, [(1, "B", "Z", "S")], "location_id int, borough string, zone_name string, service_zone string")),
        star.dim_vendor(read_seed(spark, "vendors")))
    star.incremental_fact(star.enrich(star.arriving(raw, registry.where("source_file_id < 3"), warehouse)),
                          warehouse, build, only_new=True)
    rest = star.arriving(raw, registry, warehouse)
    assert "dynamicpruning" in rest._jdf.queryExecution().executedPlan().toString()
    assert {r["source_file_id"] for r in rows(rest)} == {3}
    star.incremental_fact(star.enrich(rest), warehouse, build, only_new=True)
    assert star.arriving(raw, registry, warehouse) is None
    assert warehouse.read(star.FACT_TABLE).count() == 6
