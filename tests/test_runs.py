from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from fareledger.functions.columns import duration_label, object_key, partition_key, short_message
from fareledger.operators import registry, runs
from fareledger.operators.registry import StateError
from fareledger.session import literal_table
from fareledger.sources.readers import align_columns, empty
from fareledger.sources.schemas import RUN_EVENTS, SOURCE_FILES
from tests.conftest import rows

T0, T1 = datetime(2025, 3, 1, tzinfo=UTC), datetime(2025, 3, 2, tzinfo=UTC)


def sources(spark, *statuses):
    listed = literal_table(
        spark,
        [(i, "yellow_tripdata", "yellow", 2025, i, f"yellow/2025/{i:02}", s)
         for i, s in enumerate(statuses, 1)],
        "source_file_id bigint, dataset_name string, service_type string, source_year smallint, "
        "source_month smallint, partition_key string, status string",
    )
    return align_columns(listed, SOURCE_FILES)


def outcome(spark, run_id, succeeded=True, message=None):
    return literal_table(
        spark, [(run_id, succeeded, 3, 3, message)],
        "run_id bigint, succeeded boolean, rows_read bigint, rows_loaded bigint, error_message string",
    )


def test_start_and_success_load_the_source(spark):
    files, log = sources(spark, "ready"), empty(spark, RUN_EVENTS)
    log = log.unionByName(runs.start_runs(files, log, T0))
    assert [r["status"] for r in rows(runs.current_runs(log))] == ["running"]
    log = log.unionByName(runs.finish_runs(outcome(spark, 1), log, files, T1))
    run = rows(runs.current_runs(log))[0]
    assert (run["status"], run["rows_loaded"], run["warning_count"]) == ("succeeded", 3, 0)
    source = rows(registry.current_sources(files, runs.current_runs(log)))[0]
    assert source["status"] == "loaded" and source["loaded_at"] == run["finished_at"]
    with pytest.raises(StateError, match="terminal with status succeeded"):
        runs.finish_runs(outcome(spark, 1, False, "late"), log, files, T1)


def test_failure_keeps_the_source_ready(spark):
    files, log = sources(spark, "ready"), empty(spark, RUN_EVENTS)
    log = log.unionByName(runs.start_runs(files, log, T0))
    with pytest.raises(StateError, match="must not be empty"):
        runs.finish_runs(outcome(spark, 1, False, "  "), log, files, T1)
    log = log.unionByName(runs.finish_runs(outcome(spark, 1, False, "a\n b" + "x" * 2000), log, files, T1))
    run = rows(runs.current_runs(log))[0]
    assert run["status"] == "failed" and run["rows_loaded"] is None
    assert run["error_message"].startswith("Raw ingestion failed: a bxx")
    assert run["error_message"].endswith("x" * 2000)  # whole; listings shorten it
    short = runs.current_runs(log).select(short_message("error_message").alias("m"))
    assert len(rows(short)[0]["m"]) == 1000
    state = registry.current_sources(files, runs.current_runs(log))
    assert [r["status"] for r in rows(state)] == ["ready"]
    retry = rows(runs.start_runs(state, log, T1))
    assert [r["run_id"] for r in retry] == [2]


@pytest.mark.parametrize("status", ["loaded", "revision_detected"])
def test_only_ready_sources_start_or_load(spark, status):
    log = empty(spark, RUN_EVENTS)
    with pytest.raises(StateError, match=f"with status {status}"):
        runs.start_runs(sources(spark, status), log, T0)
    log = runs.start_runs(sources(spark, "ready"), log, T0)
    with pytest.raises(StateError, match="Cannot mark source 1 loaded"):
        runs.finish_runs(outcome(spark, 1), log, sources(spark, status), T1)


def test_skips_need_the_matching_reason(spark):
    log = empty(spark, RUN_EVENTS)
    skipped = rows(
        runs.log_skipped(sources(spark, "loaded", "revision_detected"), log, T0).orderBy("run_id")
    )
    assert [(r["run_id"], r["status"], r["status_reason"], r["rows_loaded"]) for r in skipped] == [
        (1, "skipped", "already_loaded", 0), (2, "skipped", "source_revision_detected", 0)
    ]
    for given, status in ((F.lit("already_loaded"), "ready"), (F.lit("why"), "loaded"), (None, "ready")):
        with pytest.raises(StateError, match="is invalid|Skip reason"):
            runs.log_skipped(sources(spark, status), log, T0, given)


def test_unknown_ids_and_statuses(spark):
    files, log = sources(spark, "ready"), empty(spark, RUN_EVENTS)
    with pytest.raises(StateError, match="Unknown run ID: 9"):
        runs.finish_runs(outcome(spark, 9), log, files, T1)
    with pytest.raises(StateError, match="Unknown source file ID: 5"):
        registry.get_source(files, 5)
    assert rows(registry.get_source(files, 1))[0]["partition_key"] == "yellow/2025/01"
    with pytest.raises(Exception, match="Unknown source status: odd"):
        sources(spark, "odd").select(registry.decide("status")).collect()


def test_latest_success_ignores_failed_and_unloaded(spark):
    log = literal_table(
        spark,
        [(1, 1, "succeeded", 1), (2, 1, "succeeded", 1), (3, 1, "failed", 1), (4, 2, "succeeded", 2)],
        "run_id bigint, source_file_id bigint, status string, source_month smallint",
    ).select("*", F.lit("yellow").alias("service_type"), F.lit("yellow_tripdata").alias("dataset_name"),
             F.lit(2025).alias("source_year"))
    files = sources(spark, "loaded", "revision_detected")
    assert [r["run_id"] for r in rows(runs.latest_success(log, files))] == [2]
    assert rows(runs.latest_success(log, files, "green")) == []


def test_active_zone_prefers_latest_load_nulls_last(spark):
    files = literal_table(
        spark,
        [(1, "taxi_zone_lookup", "loaded", T1), (2, "taxi_zone_lookup", "loaded", T0),
         (3, "taxi_zone_lookup", "loaded", None), (4, "taxi_zone_lookup", "ready", T1)],
        "source_file_id bigint, dataset_name string, status string, loaded_at timestamp",
    )
    zones = literal_table(spark, [(1,), (1,), (3,)], "_source_file_id bigint")
    assert rows(registry.active_zone_source(files, zones)) == [{"source_file_id": 1, "zone_count": 2}]
    no_rows = zones.where("_source_file_id <> 1")
    assert rows(registry.active_zone_source(files, no_rows)) == []


def test_local_storage_never_erases_a_durable_record(spark):
    files = sources(spark, "loaded").withColumn("storage_backend", F.lit("local"))

    def update(backend, uri):
        return literal_table(
            spark, [(1, backend, uri, None, T0)],
            "source_file_id bigint, storage_backend string, storage_uri string, "
            "storage_version_id string, stored_at timestamp",
        )

    durable = registry.merge_storage(files, update("s3", "s3://archive/k"))
    after = registry.merge_storage(durable, update("local", None))
    assert [(r["storage_backend"], r["storage_uri"]) for r in rows(after)] == [("s3", "s3://archive/k")]
    assert registry.merge_storage(files, update("local", None)).columns == files.columns


def test_keys_and_labels(spark):
    df = literal_table(
        spark, [("yellow", 2025, 1), ("green", 2024, 12), ("yellow", 999, 1), ("yellow", 2025, 13),
                (None, None, None)], "s string, y int, m int",
    )
    got = [tuple(r) for r in df.select(
        partition_key("s", "y", "m"), object_key("s", "y", "m", F.lit("abc"))).collect()]
    assert got == [
        ("yellow/2025/01", "landing/yellow/2025/01/abc.parquet"),
        ("green/2024/12", "landing/green/2024/12/abc.parquet"),
        (None, None), (None, None), (None, "landing/reference/taxi_zones/abc.csv"),
    ]
    clocks = literal_table(
        spark,
        [(T0, T1), (T0, None), (None, None), (T1, T0), (T0, datetime(2025, 3, 1, 0, 1, 5, tzinfo=UTC)),
         (T0, datetime(2025, 3, 1, 2, 0, 9, tzinfo=UTC))],
        "a timestamp, b timestamp",
    )
    labels = [r[0] for r in clocks.select(duration_label("a", "b")).collect()]
    assert labels == ["24h 0m 0s", "In progress", "—", "0s", "1m 5s", "2h 0m 9s"]
