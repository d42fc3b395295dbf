"""Maintained aggregates against the facts they stand for, and file ranges in plans."""

import uuid
from datetime import date

import pytest

from fareledger.catalog import trips as source
from fareledger.catalog.model import BOUNDS
from fareledger.operators import checks
from fareledger.plans import analytics, rollup, star
from fareledger.session import literal_table, shared_dir
from fareledger.sources.tables import Warehouse
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"
FILTERS = [{}, {"service_type": "order"}, BOUNDS, BOUNDS | {"service_type": "line"},
           {"end": date(1994, 2, 3)}, {"start": date(2030, 1, 1)}, {"service_type": "none"}]


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == {k: pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for k, v in b.items()}


@pytest.mark.parametrize("bounds", FILTERS, ids=str)
def test_rollup_equals_facts(spark, bounds):
    facts, dates, zones, _, partials, ranges = source.served(spark, SF_DIR)
    close(rows(rollup.summary(partials, dates, **bounds)), rows(analytics.summary(facts, dates, **bounds)))
    close(rows(rollup.monthly(partials, dates, **bounds)), rows(analytics.monthly(facts, dates, **bounds)))
    close(rows(rollup.top_zones(partials, dates, zones, 7, **bounds)),
          rows(analytics.top_zones(facts, dates, zones, 7, **bounds)))
    close(rows(analytics.summary(facts, dates, ranges=ranges, **bounds)),
          rows(analytics.summary(facts, dates, **bounds)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_served_queries_read_no_fact_and_ranges_prune_files(spark):
    facts, dates, _, _, partials, ranges = source.served(spark, SF_DIR)
    assert "fct_trips" not in plan(rollup.monthly(partials, dates))
    pruned = analytics.summary(facts, dates, ranges=ranges, **BOUNDS)
    assert "dynamicpruning" in plan(pruned)
    inside = ranges.where("max_date_key >= 19960101 and min_date_key <= 19960331").count()
    assert 0 < inside < ranges.count()


def test_refresh_adds_new_files_only(spark):
    facts = source.served(spark, SF_DIR)[0]
    warehouse = Warehouse(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    ids = sorted(r["source_file_id"] for r in rows(facts.select("source_file_id").distinct()))
    for chosen in (ids[:3], ids[3:9]):
        new = facts.where(facts.source_file_id.isin(chosen))
        new.write.mode("append").partitionBy("source_file_id").parquet(warehouse.path(star.FACT_TABLE))
        stored, ranges = rollup.refresh(warehouse)
        assert stored.agg({"trip_count": "sum"}).first()[0] == warehouse.read(star.FACT_TABLE).count()
    assert ranges.count() == 9
    before = sorted(stored.inputFiles())
    again, same = rollup.refresh(warehouse)
    assert sorted(again.inputFiles()) == before and sorted(map(str, rows(same))) == sorted(map(str, rows(ranges)))
    whole, _ = rollup.refresh(warehouse, full_refresh=True)
    direct = rollup.partials(warehouse.read(star.FACT_TABLE))
    close(rows(whole.select(*direct.columns).orderBy(*rollup.GRAIN)), rows(direct.orderBy(*rollup.GRAIN)))


def test_unknown_dates_and_empty_facts(spark):
    ddl = "source_file_id bigint, pickup_date_key int, service_type string, pickup_zone_key int, total_amount double, " \
          "trip_distance_miles double, fare_amount double, tip_amount double"
    facts = literal_table(spark, [(1, 0, "a", 0, 1.0, None, 2.0, None), (1, 0, "a", 0, None, None, 2.0, None),
                                  (2, 20240102, None, 5, -1.0, 3.0, None, 0.0)], ddl)
    got = {r["source_file_id"]: r for r in rows(rollup.file_ranges(rollup.partials(facts)))}
    assert (got[1]["min_date_key"], got[1]["row_count"], got[1]["unknown_count"]) == (None, 2, 2)
    assert (got[2]["min_date_key"], got[2]["max_date_key"], got[2]["unknown_count"]) == (20240102, 20240102, 0)
    dates = literal_table(spark, [(0, None)], "date_key int, full_date date")
    one = rows(rollup.summary(rollup.partials(facts), dates))[0]
    assert one == {"trip_count": 2, "total_amount": 1.0, "average_trip_distance_miles": None,
                   "average_fare_amount": 2.0, "average_tip_amount": None}
    assert rollup.file_ranges(rollup.partials(facts.limit(0))).count() == 0


def test_lineage_bits(spark):
    listed = [(1, n) for n in range(1, 200)] + [(1, 7), (2, 2**40), (2, -5), (2, None), (2, None), (None, 3), (3, 9)]
    df = literal_table(spark, listed, "source_file_id bigint, source_row_number bigint")
    got = {r["source_file_id"]: (r["row_count"], r["lineage_count"]) for r in rows(checks.lineage_bits(df))}
    assert got == {1: (200, 199), 2: (4, 3), None: (1, 1), 3: (1, 1)}
    assert {r["source_file_id"] for r in rows(checks.unique_lineage(df))} == {1, 2}
    assert rows(analytics.lineage_counts(df)) == [{"row_count": 206, "lineage_count": 204}]
    assert rows(analytics.lineage_counts(df.limit(0))) == [{"row_count": 0, "lineage_count": 0}]
    names = [line for line in plan(analytics.lineage_counts(df)).split("\n") if "Exchange" in line]
    assert names and not any("source_row_number" in line for line in names)
