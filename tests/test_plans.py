"""Shapes of the physical plans that matter at scale."""

from datetime import date

from fareledger.catalog import trips as source
from fareledger.operators import quality
from fareledger.plans import analytics, star
from fareledger.plans.build import fact_builder
from fareledger.session import local_session

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_broadcasts_every_stored_dimension(spark):
    build = fact_builder(*source.dimensions(spark, SF_DIR))
    trips = star.enrich(spark.read.parquet(_stored_trips(spark)))
    text = plan(build(trips))
    assert text.count("BroadcastHashJoin") == 7
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text


def _stored_trips(spark):
    from fareledger.session import shared_dir
    path = f"{shared_dir(spark)}/plan-trips"
    source.trips(spark, SF_DIR).write.mode("overwrite").parquet(path)
    return path


def test_oversized_dimension_is_not_broadcast(spark):
    """The same join shuffles once the lookup is over the threshold."""
    build = fact_builder(*source.dimensions(spark, SF_DIR))
    trips = star.enrich(spark.read.parquet(_stored_trips(spark)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64b")
    try:
        facts = build(trips)
        assert "SortMergeJoin" in plan(facts)
        assert facts.count() == trips.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_range_reaches_the_fact_scan(spark):
    facts, dates, _, _ = source.stored_star(spark, SF_DIR)
    text = plan(analytics.summary(
        facts, dates, service_type="line", start=date(1996, 1, 1), end=date(1996, 3, 31)
    ))
    assert "GreaterThanOrEqual(pickup_date_key,19960101)" in text
    assert "LessThanOrEqual(pickup_date_key,19960331)" in text
    assert "BroadcastHashJoin" in text
    assert "passenger_count" not in text  # unread columns stay in the file


def test_scalar_rules_share_one_scan(spark):
    from fareledger.catalog.quality import KEY, LINE_RULES
    rows = spark.read.parquet(_stored_trips(spark)).selectExpr(
        "*", "2025 AS _source_year", "1 AS _source_month")
    text = plan(quality.scalar_checks(rows, LINE_RULES, [KEY]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_top_zones_keeps_only_the_top_rows(spark):
    facts, dates, zones, _ = source.stored_star(spark, SF_DIR)
    assert "TakeOrderedAndProject" in plan(analytics.top_zones(facts, dates, zones))


def test_session_settings(spark):
    assert local_session().conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_incremental_build_prunes_raw_partitions(spark, warehouse, landing):
    """A build after a load reads the new versions' partitions, and none if there are none."""
    from fareledger.plans.build import build_all
    from fareledger.plans.ingest import ingest_batch, registry_state
    from fareledger.session import materialize
    from fareledger.sources.landing import trip_source, zone_source
    root = str(landing)
    ingest_batch(warehouse, [zone_source(root), trip_source("yellow", 2025, 1, root)])
    build_all(warehouse)
    registry = registry_state(warehouse)
    assert star.new_sources(registry, star.stored_files(warehouse)).where(
        "service_type IS NOT NULL").count() == 0
    ingest_batch(warehouse, [trip_source("green", 2025, 1, root)])
    fresh = materialize(star.new_sources(registry_state(warehouse), star.stored_files(warehouse)))
    staged = star.stage_green(warehouse.raw("green_tripdata"), fresh)
    assert "dynamicpruning" in plan(staged)
    assert build_all(warehouse).facts.count() == 6
