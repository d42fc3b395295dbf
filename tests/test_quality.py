import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from fareledger.operators import quality
from fareledger.operators.registry import StateError
from fareledger.operators.rules import Rule, domain, rule_catalog
from fareledger.operators.runs import current_runs, run_quality
from fareledger.plans.ingest import ingest_batch
from fareledger.plans.quality_run import run_partition_quality, run_quality_checks
from fareledger.session import literal_table
from fareledger.sources.landing import trip_source, zone_source
from fareledger.sources.schemas import GREEN, YELLOW
from fareledger.sources.tables import write_partitions
from tests.conftest import at, rows, write_rows

# Each case breaks what its name says; together they break every rule of both catalogs.
PLAIN = {
    "VendorID": 2, "passenger_count": 3, "trip_distance": 4.4, "RatecodeID": 5,
    "store_and_fwd_flag": "Y", "PULocationID": 40, "DOLocationID": 41, "payment_type": 2,
    "fare_amount": 22.0, "extra": 1.5, "mta_tax": .25, "tip_amount": 3.0, "tolls_amount": 6.0,
    "improvement_surcharge": .3, "total_amount": 35.05, "congestion_surcharge": 2.5,
    "Airport_fee": 1.25, "cbd_congestion_fee": .5, "trip_type": 2, "ehail_fee": .75,
}
AMOUNTS = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
           "improvement_surcharge", "total_amount", "congestion_surcharge", "Airport_fee",
           "cbd_congestion_fee", "ehail_fee"]
STRANGE = {"VendorID": 3, "RatecodeID": 7, "store_and_fwd_flag": "?", "payment_type": 42,
           "PULocationID": 400, "DOLocationID": 410, "trip_type": 0}
BARE = dict.fromkeys(["passenger_count", "RatecodeID", "store_and_fwd_flag",
                      "congestion_surcharge", "Airport_fee", "ehail_fee"])
CASES = [
    ({}, "06-14 08:00", "06-14 08:20"), ({}, "06-14 08:00", "06-14 08:20"),
    ({}, "06-14 08:00", "06-14 08:20"),
    ({c: -PLAIN[c] for c in AMOUNTS}, "06-15 09:00", "06-15 09:30"),
    ({"trip_distance": 0.0, "passenger_count": 0}, "06-16 10:00", "06-16 10:05"),
    (STRANGE, "06-17 11:00", "06-17 11:45"),
    (STRANGE | {"VendorID": 4}, "06-17 12:00", "06-17 12:45"),
    (BARE, "06-18 12:00", "06-18 11:59"),
    ({"extra": 0.0}, "07-01 00:00", "07-01 00:09"),
]


def cases(contract, prefix):
    made = []
    for changes, start, stop in CASES:
        values = PLAIN | changes | {f"{prefix}_pickup_datetime": at(f"2019-{start}"),
                                    f"{prefix}_dropoff_datetime": at(f"2019-{stop}")}
        made.append({name: values[name] for name in contract.names})
    return made


# Failing rows of each kind of case; every other rule fails in one row.
SEVERAL = {"exact_duplicate_source_rows": 3} | dict.fromkeys(
    ["unexpected_vendor_id", "unexpected_rate_code", "unexpected_store_and_fwd_flag",
     "unexpected_payment_type", "unexpected_trip_type", "unknown_pickup_zone",
     "unknown_dropoff_zone"], 2)


@pytest.fixture
def loaded(spark, warehouse, tmp_path):
    root = tmp_path / "cases"
    write_rows(root / "data/landing/yellow/2019/06.parquet", YELLOW.fields, cases(YELLOW, "tpep"))
    write_rows(root / "data/landing/green/2019/06.parquet", GREEN.fields, cases(GREEN, "lpep"))
    zones = root / "data/landing/reference/taxi_zone_lookup.csv"
    zones.parent.mkdir(parents=True)
    zones.write_text("LocationID,Borough,Zone,service_zone\n40,North,Quay,A\n41,South,Mill,B\n")
    ingest_batch(warehouse, [trip_source("yellow", 2019, 6, str(root)),
                             trip_source("green", 2019, 6, str(root)), zone_source(str(root))])
    return warehouse


def run_of(warehouse, service):
    return next(r["run_id"] for r in rows(current_runs(warehouse.run_events()))
                if r["dataset_name"] == f"{service}_tripdata")


def test_every_rule_is_broken_and_a_rerun_keeps_ids(spark, loaded):
    runs = {service: run_of(loaded, service) for service in ("yellow", "green")}
    summary = {r["run_id"]: r for r in rows(run_quality_checks(loaded, list(runs.values())))}
    for service, run in runs.items():
        catalog = rule_catalog(f"{service}_tripdata")
        found = rows(run_quality(loaded.quality_results(), run))
        assert [r["check_name"] for r in found] == [r.name for r in catalog]
        assert {r["check_name"]: r["rows_failed"] for r in found} == {
            r.name: SEVERAL.get(r.name, 1) for r in catalog}
        assert {r["rows_checked"] for r in found} == {len(CASES)}
        warnings = sum(r.severity == "WARNING" for r in catalog)
        assert summary[run]["rows_checked"] == len(CASES)
        assert summary[run]["check_count"] == len(catalog)
        assert (summary[run]["warnings_violated"], summary[run]["errors_violated"]) == (warnings, 0)
        by = {r["check_name"]: r for r in found}
        assert json.loads(by["exact_duplicate_source_rows"]["details"]) == {
            "duplicate_excess_rows": 2, "duplicate_groups": 1}
        assert json.loads(by["unexpected_vendor_id"]["details"]) == {"unexpected_value_count": 2}
    assert summary[runs["yellow"]]["partition_key"] == "yellow/2019/06"
    values = loaded.quality_values().where(F.col("run_id") == runs["green"])
    assert {(r["check_name"], r["int_value"], r["text_value"], r["count"]) for r in rows(values)} == {
        ("unexpected_vendor_id", 3, None, 1), ("unexpected_vendor_id", 4, None, 1),
        ("unexpected_rate_code", 7, None, 2), ("unexpected_store_and_fwd_flag", None, "?", 2),
        ("unexpected_payment_type", 42, None, 2), ("unexpected_trip_type", 0, None, 2)}

    first = rows(run_quality(loaded.quality_results(), runs["yellow"]))
    stored = loaded.quality_results().count()
    run_partition_quality(loaded, "yellow", 2019, 6, datetime(2030, 1, 1, tzinfo=UTC))
    again = rows(run_quality(loaded.quality_results(), runs["yellow"]))
    assert [r["quality_result_id"] for r in again] == [r["quality_result_id"] for r in first]
    assert all(a["executed_at"] != b["executed_at"] for a, b in zip(again, first))
    assert loaded.quality_results().count() == stored == 55
    run = next(r for r in rows(current_runs(loaded.run_events())) if r["run_id"] == runs["yellow"])
    assert (run["status"], run["error_count"]) == ("succeeded", 0)
    assert run["warning_count"] == len(rows(
        run_quality(loaded.quality_results(), runs["yellow"], "WARNING", "violated")))


def test_a_rule_without_a_measure_is_an_error(spark):
    rules = [domain("code_domain", "code", [1])]
    df = literal_table(spark, [(1, 5)], "k int, code int")
    targets = literal_table(spark, [(9, 1)], "run_id bigint, k int")
    at_noon = datetime(2025, 1, 1, tzinfo=UTC)
    measures = quality.measure(df, rules, ["k"])
    more = [*rules, domain("other_domain", "code", [5])]
    with pytest.raises(Exception, match="in the catalog, but not measured: other_domain"):
        rows(quality.quality_results(measures, more, targets, "k", at_noon))
    with pytest.raises(Exception, match="measured, but in no catalog: code_domain"):
        rows(quality.quality_results(measures, more[1:], targets, "k", at_noon))
    with pytest.raises(ValueError, match="room for"):
        quality.quality_results(measures, rules * 1000, targets, "k", at_noon)


def test_targets_are_validated(spark, loaded):
    with pytest.raises(StateError, match="Unknown pipeline run ID: 99"):
        run_quality_checks(loaded, [99])
    zones = next(r["run_id"] for r in rows(current_runs(loaded.run_events()))
                 if r["dataset_name"] == "taxi_zone_lookup")
    with pytest.raises(StateError, match="not a supported loaded trip"):
        run_quality_checks(loaded, [zones])
    with pytest.raises(StateError, match="No successful loaded run for green/2019/07"):
        run_partition_quality(loaded, "green", 2019, 7)


def test_quality_needs_zones(spark, warehouse, landing):
    ingest_batch(warehouse, [trip_source("yellow", 2025, 1, str(landing))])
    with pytest.raises(StateError, match="No loaded Taxi Zone"):
        run_quality_checks(warehouse, [1])


def test_files_without_rows_pass_with_zero_rate(spark):
    rules = rule_catalog("yellow_tripdata")
    from fareledger.sources.readers import empty
    raw = empty(spark, YELLOW.raw_schema).withColumn("_source_year", F.lit(2025)).withColumn(
        "_source_month", F.lit(1))
    zones = literal_table(spark, [(1,)], "LocationID int")
    measures = quality.measure(raw, rules, ["_source_file_id"], zones, "LocationID", YELLOW.names)
    targets = literal_table(spark, [(5, 7)], "run_id bigint, _source_file_id bigint")
    found = rows(quality.quality_results(
        measures, rules, targets, "_source_file_id", datetime(2025, 1, 1, tzinfo=UTC)))
    assert len(found) == 27
    assert {(r["status"], r["rows_checked"], r["failure_rate"]) for r in found} == {("passed", 0, 0.0)}


def test_many_unexpected_values_stay_whole(spark, warehouse):
    df = spark.range(12_000).select(F.lit(1).alias("k"), (F.col("id") + 100).alias("code"))
    rules = [domain("code_domain", "code", [1, 2])]
    counts = quality.domain_counts(df, rules, ["k"])
    total = rows(quality.domain_totals(counts, ["k"]))[0]
    assert total["rows_failed"] == 12_000
    assert json.loads(total["details"]) == {"unexpected_value_count": 12_000}
    targets = literal_table(spark, [(4, 1)], "run_id bigint, k int")
    write_partitions(quality.quality_values(counts, targets, "k"), warehouse.path("ops/quality_values"), "run_id")
    stored = warehouse.quality_values()
    assert stored.where("count = 1 AND run_id = 4").select("int_value").distinct().count() == 12_000


def test_duplicates_match_nulls_nan_and_signed_zero(spark):
    nan = float("nan")
    df = literal_table(
        spark, [(1, 0.0), (1, -0.0), (2, None), (2, None), (3, nan), (3, nan), (4, None), (4, nan),
                (5, 1e-300), (5, 0.0)], "k int, v double",
    )
    want = {"participating_rows": 6, "excess_rows": 3, "duplicate_groups": 3, "total_rows": 10}
    for parts in (1, 8):
        assert rows(quality.exact_duplicates(df.repartition(parts))) == [want]
        assert rows(quality.exact_duplicates_prefiltered(df.repartition(parts))) == [want]
    per_key = rows(quality.exact_duplicates(df, ["k", "v"], ["k"]))
    assert {r["k"]: r["duplicate_groups"] for r in per_key} == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0}
    filtered = rows(quality.exact_duplicates_prefiltered(df, ["k", "v"], ["k"]))
    assert sorted(map(str, filtered)) == sorted(map(str, per_key))


def test_hot_copies(spark):
    """One row that is a third of all rows is one group."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    want = [{"participating_rows": 1000, "excess_rows": 999, "duplicate_groups": 1, "total_rows": 3000}]
    assert rows(quality.exact_duplicates(df)) == want
    assert rows(quality.exact_duplicates_prefiltered(df)) == want


def test_catalogs():
    yellow, green = rule_catalog("yellow_tripdata"), rule_catalog("green_tripdata")
    assert len(yellow) == 27 and len(green) == 28
    names = {r.name for r in yellow}
    assert names - {r.name for r in green} == {"negative_airport_fee", "airport_fee_null_rate"}
    assert {r.name for r in green} - names == {
        "negative_ehail_fee", "ehail_fee_null_rate", "unexpected_trip_type"}
    assert {r.severity for r in yellow + green} == {"INFO", "WARNING"}
    with pytest.raises(ValueError):
        rule_catalog("blue_tripdata")
    assert isinstance(yellow[0], Rule)
