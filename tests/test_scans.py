"""Order lines are joined and shuffled once, however many scans a query makes of them."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fareledger.catalog import raw_rules, trips
from fareledger.session import small_splits

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["q_results", "q_counters", "q_overview", "q_warnings", "q_yellow_results",
                                  "q_green_results", "p_service", "p_compare"])
def test_scans_share_the_stored_join(spark, name):
    assert "l_orderkey" not in optimized(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("rows", [trips.line_trips, lambda spark, sf: raw_rules.raw_rows(spark, sf, "yellow")])
def test_customers_meet_orders_before_lines(spark, rows):
    joins = [line for line in optimized(rows(spark, SF_DIR)).splitlines() if "Join" in line]
    with_orders = next(i for i, line in enumerate(joins) if "l_orderkey" in line)
    with_customers = next(i for i, line in enumerate(joins) if "o_custkey" in line)
    assert with_orders < with_customers  # the tree shows parents first


def test_rows_are_gathered_by_file_before_they_are_widened(spark):
    plan = optimized(trips.trips(spark, SF_DIR, by_file=True))
    gathered = [line for line in plan.splitlines() if "Rebalance" in line]
    assert len(gathered) == 2 and plan.index("total_amount") < plan.index("Rebalance")
    plain = trips.trips(spark, SF_DIR)
    both = plain.exceptAll(trips.trips(spark, SF_DIR, by_file=True))
    assert both.isEmpty() and plain.where(F.col("source_file_id").isNull()).isEmpty()


def test_dates_of_the_increments_come_from_stored_trips(spark, warehouse):
    raw, _ = trips.raw_trips(spark, SF_DIR, warehouse)
    stored, joined = (trips.dimensions(spark, SF_DIR, r)[0] for r in (raw, None))
    assert stored.count() == joined.count() and stored.exceptAll(joined).isEmpty()


@pytest.mark.parametrize("before, inside", [("128MB", str(32 << 20)), ("134217728b", str(32 << 20)), ("1m", "1m")])
def test_small_splits_only_lower_and_give_back(spark, before, inside):
    name = "spark.sql.files.maxPartitionBytes"
    kept = spark.conf.get(name)
    spark.conf.set(name, before)
    try:
        with small_splits(spark):
            assert spark.conf.get(name) == inside
        assert spark.conf.get(name) == before
    finally:
        spark.conf.set(name, kept)
