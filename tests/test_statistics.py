"""Maintained column statistics against the facts they describe."""

import uuid

import pytest

from fareledger.catalog import trips as source
from fareledger.plans import star, statistics
from fareledger.session import shared_dir
from fareledger.sources.tables import Warehouse
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def by_column(df):
    return {r["column_name"]: r for r in rows(df)}


def test_files_are_added_merged_and_not_read_again(spark):
    facts = source.served(spark, SF_DIR)[0]
    warehouse = Warehouse(spark, f"{shared_dir(spark)}/statistics-{uuid.uuid4().hex}")
    ids = sorted(r["source_file_id"] for r in rows(facts.select("source_file_id").distinct()))
    for chosen in (ids[:3], ids[3:]):
        new = facts.where(facts.source_file_id.isin(chosen))
        new.write.mode("append").partitionBy("source_file_id").parquet(warehouse.path(star.FACT_TABLE))
        stored = statistics.refresh(warehouse)
    found = by_column(statistics.merged(stored))
    for column in statistics.KEYS + statistics.TEXTS:
        values = [r[column] for r in rows(facts.select(column))]
        known = [v for v in values if v is not None]
        low, high = ("min_key", "max_key") if column in statistics.KEYS else ("min_text", "max_text")
        got = found[column]
        assert (got["row_count"], got["null_count"]) == (len(values), len(values) - len(known))
        assert (got[low], got[high]) == (min(known, default=None), max(known, default=None))
        assert got["distinct_estimate"] == pytest.approx(len(set(known)), rel=0.05)
    # With nothing new the stored statistics are what is read, and no fact is.
    again = statistics.refresh(warehouse)
    assert "fct_trips" not in again._jdf.queryExecution().executedPlan().toString()
    assert again.count() == stored.count() == len(ids) * len(found)


def test_columns_without_values_and_empty_tables(spark):
    facts = spark.createDataFrame([(1, None, "a", 0), (1, None, None, 0), (2, 5, "", 0)],
                                  "source_file_id long, number int, word string, column_name int")
    stats = statistics.file_statistics(facts, ("number",), ("word",))
    got = {(r["source_file_id"], r["column_name"]): r for r in rows(stats)}
    assert (got[1, "number"]["null_count"], got[1, "number"]["min_key"], got[1, "number"]["row_count"]) == (2, None, 2)
    assert (got[2, "word"]["min_text"], got[2, "word"]["null_count"]) == ("", 0)
    total = by_column(statistics.merged(stats))
    assert (total["number"]["distinct_estimate"], total["word"]["distinct_estimate"]) == (1, 2)
    assert statistics.file_statistics(facts.limit(0), ("number",), ("word",)).count() == 0
    assert statistics.merged(stats, "source_file_id").count() == 4
