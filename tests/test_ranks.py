import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareledger.functions import ranks
from fareledger.session import literal_table
from tests.conftest import rows

PERCENTS = {"p0": 0.0, "p01": .01, "p50": .5, "p95": .95, "p99": .99, "p1": 1.0}


@pytest.fixture(autouse=True)
def generated_code(spark):
    """The session of the tests interprets plans; ranks are tested as they run elsewhere."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


def group(spark, values):
    return literal_table(spark, [(v,) for v in values], "v double")


CASES = {
    "one": [3.5],
    "two": [1.0, 2.0],
    "same": [7.0] * 50,
    "hot": [5.0] * 300 + [float(i) for i in range(600)],
    "wide": [random.Random(1).expovariate(1e-3) for _ in range(500)] + [-1e12, 1e12],
}


@pytest.mark.parametrize("name", CASES)
def test_linear_percentiles_equal_numpy(spark, name):
    values = CASES[name]
    got = rows(ranks.exact_percentiles(group(spark, values), "v", PERCENTS))[0]
    for label, p in PERCENTS.items():
        assert got[label] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_groups_that_span_parts(spark):
    """Hot, spread, tiny, empty and null groups over many small parts and batches."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rng = random.Random(4)
        groups = {"hot": [0.0] * 700 + [float(i) for i in range(900)], "spread": [rng.gauss(0, 9) for _ in range(400)],
                  "one": [2.5], "two": [1.0, 1.0, 4.0], None: [float(i % 7) for i in range(60)]}
        listed = [(k, v) for k, vs in groups.items() for v in vs] + [("nothing", None)] * 3
        rng.shuffle(listed)
        df = literal_table(spark, listed, "k string, v double").repartition(6)
        got = {r["k"]: r for r in rows(ranks.exact_percentiles(df, "v", PERCENTS, ["k"]))}
        assert set(got) == set(groups)
        for key, values in groups.items():
            for label, p in PERCENTS.items():
                assert got[key][label] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), (key, label)
        near = {r["k"]: r["percentile"] for r in rows(ranks.nearest_rank_percentile(df, "v", .95, ["k"]))}
        assert near == {k: sorted(vs)[math.ceil(.95 * len(vs)) - 1] for k, vs in groups.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_window_over_values(spark):
    """Windows see one row a part and group; values are range-partitioned."""
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = ranks.exact_percentiles(df, "v", PERCENTS, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window" in line]
    assert windows and all("_size" in line for line in windows)


def test_groups_and_partitions_do_not_matter(spark):
    df = spark.range(2000).select(
        (F.col("id") % 3).alias("k"), F.hash("id").cast("double").alias("v"))
    one = sorted(map(str, rows(ranks.median_by(df.repartition(1), "v", ["k"]))))
    many = sorted(map(str, rows(ranks.median_by(df.repartition(8), "v", ["k"]))))
    assert one == many and len(one) == 3


def test_nearest_rank(spark):
    df = group(spark, [5.0, 1.0, 4.0, 2.0, 3.0])
    for p, want in ((.95, 5.0), (.5, 3.0), (.2, 1.0), (.21, 2.0), (1.0, 5.0)):
        assert rows(ranks.nearest_rank_percentile(df, "v", p)) == [{"percentile": want}]
    for p in (0, 1.5, -1):
        with pytest.raises(ValueError):
            ranks.nearest_rank_percentile(df, "v", p)


def test_number_rows_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(7)
    got = ranks.number_rows(df, F.col("v").desc(), name="n")
    assert sorted((r["n"], r["v"]) for r in rows(got)) == [(i + 1, 999 - i) for i in range(1000)]
    assert rows(ranks.number_rows(df.limit(0), "v")) == []
