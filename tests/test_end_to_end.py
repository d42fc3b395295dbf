"""Files to facts: load, build, rebuild, add a month, query."""

from fareledger.plans import analytics
from fareledger.plans.build import build_all, build_and_test, model_tests, violations_per_test
from fareledger.plans.ingest import ingest_batch
from fareledger.sources.landing import trip_source, zone_source
from fareledger.sources.schemas import YELLOW
from tests.conftest import YELLOW_LATER, rows, write_rows


def facts_by_lineage(df):
    return {
        (r["source_file_id"], r["source_row_number"]): r for r in rows(df)
    }


def test_fixture_pipeline(spark, warehouse, landing):
    root = str(landing)
    sources = [zone_source(root), trip_source("yellow", 2025, 1, root),
               trip_source("green", 2025, 1, root)]
    result = rows(ingest_batch(warehouse, sources))
    assert sorted((r["partition_key"], r["status"], r["rows_loaded"]) for r in result) == [
        ("green/2025/01", "succeeded", 3),
        ("reference/taxi_zones", "succeeded", 2),
        ("yellow/2025/01", "succeeded", 3),
    ]
    models = build_and_test(warehouse)
    first = facts_by_lineage(models.facts)
    assert len(first) == 6
    assert rows(analytics.lineage_counts(models.facts)) == [{"row_count": 6, "lineage_count": 6}]
    again = build_all(warehouse)
    assert facts_by_lineage(again.facts) == first

    write_rows(landing / "data/landing/yellow/2025/02.parquet", YELLOW.fields, YELLOW_LATER)
    ingest_batch(warehouse, [trip_source("yellow", 2025, 2, root)])
    later = build_all(warehouse)
    grown = facts_by_lineage(later.facts)
    assert len(grown) == 8 and {k: grown[k] for k in first} == first
    rebuilt = build_all(warehouse, full_refresh=True)
    assert facts_by_lineage(rebuilt.facts) == grown

    assert rows(analytics.summary(rebuilt.facts, rebuilt.dates))[0]["trip_count"] == 8
    months = rows(analytics.monthly(rebuilt.facts, rebuilt.dates))
    assert [(r["month"] and r["month"].isoformat(), r["service_type"], r["trip_count"])
            for r in months] == [
        ("2025-01-01", "green", 3), ("2025-01-01", "yellow", 2), ("2025-02-01", "yellow", 2),
        (None, "yellow", 1),
    ]
    zones = rows(analytics.top_zones(rebuilt.facts, rebuilt.dates, rebuilt.dim_zone))
    assert sum(r["trip_count"] for r in zones) == 8
    assert zones[-1]["borough"] == "Unknown"
    unknown = next(r for r in grown.values() if r["pickup_date_key"] == 0)
    assert unknown["vendor_key"] == 0 and unknown["pickup_zone_key"] == 0
    assert unknown["rate_code_id"] == 57 and unknown["rate_code_name"] == "Unknown"
    assert unknown["trip_duration_seconds"] is None
    tests = model_tests(rebuilt, warehouse)
    assert len(tests) == 24
    assert rows(violations_per_test(tests).where("violations > 0")) == []
