from concurrent.futures import ThreadPoolExecutor
import pytest
from pyspark.sql import functions as F

from fareledger.operators.registry import current_sources, refused, register
from fareledger.operators.runs import current_runs
from fareledger.plans import ingest
from fareledger.plans.ingest import (
    ContractError,
    IngestionError,
    SourceRevisionError,
    ensure_loaded,
    ingest_batch,
)
from fareledger.session import materialize
from fareledger.sources.landing import trip_source, zone_source
from fareledger.sources.manifest import file_manifest, source_list
from fareledger.sources.readers import read_zones
from fareledger.sources.schemas import YELLOW
from tests.conftest import YELLOW_ROWS, rows, write_rows


def yellow(landing, month=1):
    return trip_source("yellow", 2025, month, str(landing))


def status_of(warehouse):
    return [
        (r["status"], r["status_reason"])
        for r in rows(current_runs(warehouse.run_events()).orderBy("run_id"))
    ]


def test_lineage_and_absent_additive_column(spark, warehouse, landing):
    path = landing / "data/landing/yellow/2024/12.parquet"
    write_rows(path, YELLOW.baseline, YELLOW_ROWS)
    ingest_batch(warehouse, [trip_source("yellow", 2024, 12, str(landing)), yellow(landing)])
    raw = rows(warehouse.raw("yellow_tripdata").orderBy("_source_file_id", "_source_row_number"))
    assert [(r["_source_file_id"], r["_source_row_number"]) for r in raw] == [
        (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)
    ]
    assert [r["cbd_congestion_fee"] for r in raw] == [None, None, None, .5, None, .5]
    assert [r["VendorID"] for r in raw[:3]] == [6, 7, 41]
    assert {r["_pipeline_run_id"] for r in raw} == {1, 2}


def test_second_load_is_skipped_and_revision_blocked(spark, warehouse, landing):
    ingest_batch(warehouse, [yellow(landing)])
    again = rows(ensure_loaded(warehouse, [yellow(landing)]))
    assert [(r["status"], r["status_reason"], r["decision"], r["rows_loaded"]) for r in again] == [
        ("skipped", "already_loaded", "already_loaded", 0)
    ]
    before = rows(warehouse.raw("yellow_tripdata"))
    write_rows(landing / "data/landing/yellow/2025/01.parquet", YELLOW.fields, YELLOW_ROWS[:2])
    with pytest.raises(SourceRevisionError, match="yellow/2025/01"):
        ensure_loaded(warehouse, [yellow(landing)])
    assert rows(warehouse.raw("yellow_tripdata")) == before
    assert status_of(warehouse) == [
        ("succeeded", None), ("skipped", "already_loaded"), ("skipped", "source_revision_detected")
    ]
    sources = rows(warehouse.registrations().orderBy("source_file_id"))
    assert [(r["source_file_id"], r["status"]) for r in sources] == [
        (1, "ready"), (2, "revision_detected")
    ]
    ingest_batch(warehouse, [yellow(landing)])
    assert warehouse.registrations().count() == 2


def test_failed_load_leaves_source_ready_and_retries(spark, warehouse, landing, monkeypatch):
    whole = ingest.read_raw

    def broken(*args):
        return whole(*args).withColumn("VendorID", F.raise_error(F.lit("disk  gone")).cast("int"))

    monkeypatch.setattr(ingest, "read_raw", broken)
    with pytest.raises(IngestionError, match="disk"):
        ingest_batch(warehouse, [yellow(landing)])
    assert warehouse.raw("yellow_tripdata").count() == 0
    state = rows(current_sources(warehouse.registrations(), current_runs(warehouse.run_events())))
    assert [r["status"] for r in state] == ["ready"]
    failed = rows(current_runs(warehouse.run_events()))[0]
    assert failed["error_message"].startswith("Raw ingestion failed: ")
    assert len(failed["error_message"]) <= 1000
    monkeypatch.setattr(ingest, "read_raw", whole)
    result = rows(ingest_batch(warehouse, [yellow(landing)]))
    assert [(r["run_id"], r["source_file_id"], r["status"]) for r in result] == [(2, 1, "succeeded")]
    state = rows(current_sources(warehouse.registrations(), current_runs(warehouse.run_events())))
    runs = {r["run_id"]: r for r in rows(current_runs(warehouse.run_events()))}
    assert state[0]["status"] == "loaded" and state[0]["loaded_at"] == runs[2]["finished_at"]


def test_count_mismatch_fails_the_file(spark, warehouse, landing):
    listed = source_list(spark, [yellow(landing)])
    manifest = materialize(file_manifest(listed).withColumn("row_count", F.lit(4).cast("bigint")))
    with pytest.raises(IngestionError, match="Row-count mismatch: read 3, expected 4"):
        ingest_batch(warehouse, [], manifest=manifest)
    assert status_of(warehouse) == [("failed", None)]
    state = rows(current_sources(warehouse.registrations(), current_runs(warehouse.run_events())))
    assert [r["status"] for r in state] == ["ready"]


def test_refused_file_registers_nothing(spark, warehouse, landing):
    (landing / "data/landing/yellow/2025/02.parquet").write_bytes(b"")
    with pytest.raises(ContractError, match="empty"):
        ingest_batch(warehouse, [yellow(landing), yellow(landing, 2)])
    assert not warehouse.exists("ops/source_files")
    result = rows(ingest_batch(warehouse, [yellow(landing), yellow(landing, 2)], strict=False))
    assert sorted((r["partition_key"], r["status"], r["run_id"]) for r in result) == [
        ("yellow/2025/01", "succeeded", 1), ("yellow/2025/02", "refused", None)]
    assert all("empty" in r["error_message"] for r in result if r["status"] == "refused")
    kept = rows(warehouse.read("ops/refused_files"))
    assert [r["path"].rsplit("/", 1)[1] for r in kept] == ["02.parquet"] * 2


def test_bad_files_stand_alone(spark, warehouse, landing):
    """One torn file among thirty, and one without its rows: 28 load, two fail by themselves."""
    months = [(2021 + i // 12, i % 12 + 1) for i in range(30)]
    sources = []
    for i, (year, month) in enumerate(months):
        path = landing / f"data/landing/yellow/{year}/{month:02d}.parquet"
        write_rows(path, YELLOW.fields, [YELLOW_ROWS[0] | {"fare_amount": float(i)}])
        sources.append(trip_source("yellow", year, month, str(landing)))
    manifest = materialize(file_manifest(source_list(spark, sources)))
    torn = landing / "data/landing/yellow/2022/05.parquet"
    content = bytearray(torn.read_bytes())
    content[4:200] = bytes(196)  # the footer stays whole
    torn.write_bytes(bytes(content))
    wrong = manifest.withColumn("row_count", F.when(
        F.col("partition_key") == "yellow/2021/03", F.lit(9)).otherwise(F.col("row_count")).cast("bigint"))
    result = {r["partition_key"]: r for r in rows(ingest_batch(warehouse, [], manifest=wrong, strict=False))}
    bad = {k: r["error_message"] for k, r in result.items() if r["status"] == "failed"}
    assert sorted(bad) == ["yellow/2021/03", "yellow/2022/05"]
    assert "Row-count mismatch" in bad["yellow/2021/03"] and "mismatch" not in bad["yellow/2022/05"]
    assert sum(r["status"] == "succeeded" for r in result.values()) == 28
    loaded = {r["fare_amount"] for r in rows(warehouse.raw("yellow_tripdata"))}
    assert loaded == set(map(float, range(30))) - {16.0}
    torn.write_bytes(bytes(content))
    write_rows(torn, YELLOW.fields, [YELLOW_ROWS[0] | {"fare_amount": 16.0}])
    again = rows(ingest_batch(warehouse, [], manifest=manifest, strict=False))
    assert sorted((r["partition_key"], r["status"]) for r in again if r["status"] != "skipped") == [
        ("yellow/2021/03", "succeeded"), ("yellow/2022/05", "succeeded")]


def test_batches_at_once_share_no_id(spark, warehouse, landing):
    sources = [[yellow(landing)], [trip_source("green", 2025, 1, str(landing))], [zone_source(str(landing))]]
    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(lambda one: rows(ingest_batch(warehouse, one)), sources))
    assert all(r["status"] == "succeeded" for result in results for r in result)
    assert sorted(r["source_file_id"] for r in rows(warehouse.registrations())) == [1, 2, 3]
    assert sorted(r["run_id"] for result in results for r in result) == [1, 2, 3]


def test_a_marker_is_held_by_one_writer(spark, warehouse):
    with warehouse.exclusive("x"):
        with pytest.raises(TimeoutError):
            with warehouse.exclusive("x", wait=0.3):
                pass
        with warehouse.exclusive("y"):
            pass
    with warehouse.exclusive("x", wait=0.1):  # let go
        with warehouse.exclusive("x", wait=5, lease=-1):  # or its holder is taken for dead
            pass


def test_registration_rules(spark, warehouse, landing):
    write_rows(landing / "other.parquet", YELLOW.fields, YELLOW_ROWS[:1])
    sources = [yellow(landing), yellow(landing) | {"path": str(landing / "other.parquet")}]
    manifest = materialize(file_manifest(source_list(spark, sources)))
    outcome = materialize(register(manifest, warehouse.registrations(), "path"))
    assert sorted((r["source_file_id"], r["status"], r["decision"]) for r in rows(outcome)) == [
        (1, "ready", "proceed"), (2, "revision_detected", "source_revision_blocked")
    ]
    again = register(manifest, outcome.drop("decision"), "path")
    assert {(r["source_file_id"], r["is_new"]) for r in rows(again)} == {(1, False), (2, False)}
    for size in (F.lit(0), F.lit(None).cast("bigint")):
        hollow = manifest.withColumn("file_size_bytes", size)
        assert refused(hollow).count() == 2
        with pytest.raises(Exception, match="refused, a version without bytes: yellow/2025/01"):
            rows(register(hollow, outcome, "path").select("partition_key"))


def test_zone_csv_text_is_kept(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_bytes(
        b"\xef\xbb\xbf"
        b'service_zone,"Zone",LocationID,Borough\r\n'
        b'N/A,"two ""quoted"", here",3,\r\n"","line\nbreak",1,Queens\r\n,x,2,NA\r\n'
    )
    got = rows(read_zones(spark, str(path)).drop("_file").orderBy("_source_row_number"))
    assert got == [
        {"LocationID": 3, "Borough": "", "Zone": 'two "quoted", here', "service_zone": "N/A",
         "_source_row_number": 1},
        {"LocationID": 1, "Borough": "Queens", "Zone": "line\nbreak", "service_zone": "",
         "_source_row_number": 2},
        {"LocationID": 2, "Borough": "NA", "Zone": "x", "service_zone": "", "_source_row_number": 3},
    ]
    path.write_text("LocationID,Borough,Zone,service_zone\nten,a,b,c\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_zones(spark, str(path)).collect()


def test_paths_with_odd_characters(spark, warehouse, tmp_path):
    root = tmp_path / "a b+c%20é"
    write_rows(root / "data/landing/yellow/2025/01.parquet", YELLOW.fields, YELLOW_ROWS)
    result = rows(ingest_batch(warehouse, [trip_source("yellow", 2025, 1, str(root))]))
    assert [(r["status"], r["rows_loaded"]) for r in result] == [("succeeded", 3)]


def test_zone_source_loads_once(spark, warehouse, landing):
    zones = zone_source(str(landing))
    ingest_batch(warehouse, [zones])
    assert rows(warehouse.raw("taxi_zone_lookup").select("LocationID", "_source_row_number")
                .orderBy("LocationID")) == [
        {"LocationID": 11, "_source_row_number": 1}, {"LocationID": 12, "_source_row_number": 2}
    ]
