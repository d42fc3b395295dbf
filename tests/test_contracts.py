import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareledger.session import literal_table
from fareledger.sources import contracts, manifest
from fareledger.sources.landing import Month, resolve_month, trip_source, zone_source
from fareledger.sources.schemas import GREEN, YELLOW
from tests.conftest import GREEN_ROWS, YELLOW_ROWS, arrow_schema, at, rows, write_rows


def empty_file(path, schema):
    pq.write_table(schema.empty_table(), path)
    return str(path)


def check(spark, tmp_path, schemas):
    """Contract outcome per file name for Arrow schemas of a dataset."""
    listed = [(empty_file(tmp_path / f"{n}.parquet", s), d) for n, (d, s) in schemas.items()]
    datasets = literal_table(spark, listed, "path string, dataset_name string")
    found = contracts.validate_contract(manifest.footer_stats(datasets), datasets)
    return {
        r["path"].rsplit("/", 1)[1][:-8]: (r["schema_version"], r["contract_problem"])
        for r in rows(found)
    }


def test_contract_versions_and_problems(spark, tmp_path):
    y1, y2 = arrow_schema(YELLOW.baseline), arrow_schema(YELLOW.fields)
    green = arrow_schema(GREEN.fields)
    swapped = pa.schema([y1.field(1), y1.field(0), *list(y1)[2:]])
    early = pa.schema([y2.field(19), *list(y1)])
    strict = y1.set(4, pa.field("trip_distance", pa.float64(), nullable=False))
    got = check(spark, tmp_path, {
        "v1": ("yellow_tripdata", y1),
        "v2": ("yellow_tripdata", y2),
        "green": ("green_tripdata", green),
        "missing": ("yellow_tripdata", y1.remove(3).remove(0)),
        "unknown": ("yellow_tripdata", y1.append(pa.field("tax2", pa.int32()))),
        "order": ("yellow_tripdata", swapped),
        "early": ("yellow_tripdata", early),
        "type": ("green_tripdata", green.set(0, pa.field("VendorID", pa.int64()))),
        "nullability": ("yellow_tripdata", strict),
        "greenmissing": ("green_tripdata", green.remove(20)),
    })
    assert got == {
        "v1": ("yellow_v1", None),
        "v2": ("yellow_v2", None),
        "green": ("green_v1", None),
        "missing": (None, "Missing baseline Yellow fields: VendorID, passenger_count"),
        "unknown": (None, "Unsupported Yellow fields: tax2"),
        "order": (None, "Unsupported Yellow source column order"),
        "early": (None, "Unsupported Yellow source column order"),
        "type": (None, "Unsupported type for VendorID: expected int32, got int64"),
        "nullability": (None, "Unsupported nullability for trip_distance: expected nullable"),
        "greenmissing": (None, "Missing baseline Green fields: cbd_congestion_fee"),
    }


def test_published_fingerprints(spark, tmp_path):
    schemas = {"v1": arrow_schema(YELLOW.baseline), "v2": arrow_schema(YELLOW.fields),
               "green": arrow_schema(GREEN.fields)}
    listed = literal_table(
        spark, [(empty_file(tmp_path / f"{n}.parquet", s),) for n, s in schemas.items()],
        "path string",
    )
    found = manifest.schema_fingerprint(manifest.footer_stats(listed))
    assert {r["path"].rsplit("/", 1)[1][:-8]: r["schema_fingerprint"] for r in rows(found)} == {
        "v1": "a4ec3c7b9c38f45205b807a5d5246227351321bd6069b1e4ba3fd67c02871674",
        "v2": "d2b38a269f98178feaf927bdfb2e837852d1ebb72afdb3b08c86f8f32967998b",
        "green": "2b19cd71a35a13818165d602b7ece04499a0c9a43ba8e04074102eefad458165",
    }


def test_compare_schemas_and_presence(spark, tmp_path):
    y1, y2 = arrow_schema(YELLOW.baseline), arrow_schema(YELLOW.fields)
    changed = pa.schema([y2.field(1), y2.field(0), *list(y2)[2:]]).set(
        2, pa.field("tpep_dropoff_datetime", pa.timestamp("ms"), nullable=False)
    )
    listed = literal_table(
        spark, [(empty_file(tmp_path / f"{n}.parquet", s),) for n, s in
                {"a": y1, "b": changed}.items()], "path string",
    )
    fields = manifest.footer_stats(listed).cache()
    left, right = (fields.where(F.col("path").endswith(f"{n}.parquet")) for n in "ab")
    diff = {r["name"]: r for r in rows(contracts.compare_schemas(left, right))}
    assert diff["cbd_congestion_fee"]["presence"] == "only_right"
    assert diff["VendorID"]["presence"] == "common" and diff["VendorID"]["order_differs"]
    assert [n for n, r in diff.items() if r["type_differs"]] == ["tpep_dropoff_datetime"]
    assert [n for n, r in diff.items() if r["nullability_differs"]] == ["tpep_dropoff_datetime"]
    same = rows(contracts.compare_schemas(left, left))
    assert not any(r["order_differs"] or r["type_differs"] for r in same)
    seen = rows(contracts.documented_presence(fields, ["VendorID", "cbd_congestion_fee"]))
    assert {(r["path"][-9], r["name"]): r["present"] for r in seen} == {
        ("a", "VendorID"): True, ("a", "cbd_congestion_fee"): False,
        ("b", "VendorID"): True, ("b", "cbd_congestion_fee"): True,
    }


def test_manifest_identity_and_rejections(spark, tmp_path):
    good, blank, none, torn, other, odd = (tmp_path / f"{n}.parquet" for n in
                                           ("good", "blank", "none", "torn", "other", "odd"))
    write_rows(good, YELLOW.fields, YELLOW_ROWS)
    write_rows(other, GREEN.fields, GREEN_ROWS)
    blank.write_bytes(b"")
    torn.write_bytes(b"PAR1 not a parquet file")
    empty_file(none, arrow_schema(YELLOW.baseline))
    odd.write_bytes(b"x")
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n1,A,B,C\n1,A,B,C\n")

    def listed(path, dataset="yellow_tripdata", kind="parquet"):
        return trip_source("yellow", 2025, 1) | {
            "path": str(path), "dataset_name": dataset, "source_format": kind
        }

    found = manifest.file_manifest(manifest.source_list(spark, [
        listed(good), listed(blank), listed(none), listed(torn), listed(other, "blue_tripdata"),
        listed(odd, kind="orc"), zone_source() | {"path": str(zones)},
    ]))
    got = {r["path"].rsplit("/", 1)[1]: r for r in rows(found)}
    assert got["good.parquet"]["rejection"] is None
    assert got["good.parquet"]["row_count"] == 3 and got["good.parquet"]["row_group_count"] == 2
    assert got["good.parquet"]["schema_version"] == "yellow_v2"
    import hashlib
    assert got["good.parquet"]["checksum_sha256"] == hashlib.sha256(good.read_bytes()).hexdigest()
    assert got["good.parquet"]["file_size_bytes"] == good.stat().st_size
    assert got["blank.parquet"]["rejection"] == "Source file is empty"
    assert got["none.parquet"]["rejection"] == "Parquet source contains zero rows"
    assert got["torn.parquet"]["rejection"].startswith("Unreadable Parquet footer")
    assert got["other.parquet"]["rejection"] == "Unsupported Parquet dataset: blue_tripdata"
    assert got["odd.parquet"]["rejection"] == "Unsupported source format: orc"
    assert got["zones.csv"]["rejection"] == "Taxi Zone LocationID contains duplicate values"


@pytest.mark.parametrize(("text", "problem"), [
    ("LocationID,Borough,Zone\n1,a,b\n", "Missing Taxi Zone fields: service_zone"),
    ("LocationID,Borough,Zone,service_zone,more\n1,a,b,c,d\n", "Unsupported Taxi Zone fields: more"),
    ("LocationID,Borough,Zone,service_zone\n", "Taxi Zone source is empty"),
    ("LocationID,Borough,Zone,service_zone\nN/A,a,b,c\n", "Taxi Zone LocationID contains null values"),
    ("service_zone,Zone,LocationID,Borough\nc,b,1,a\n", None),
])
def test_zone_contract(spark, tmp_path, text, problem):
    path = tmp_path / "zones.csv"
    path.write_text(text)
    df = spark.read.option("header", True).csv(str(path))
    assert rows(contracts.validate_zones(df, df.columns))[0]["problem"] == problem


def test_months_and_partitions():
    assert trip_source("green", 2025, 3)["partition_key"] == "green/2025/03"
    for year, month in ((2025, 0), (2025, 13), (999, 1)):
        with pytest.raises(ValueError):
            trip_source("yellow", year, month)
    with pytest.raises(ValueError):
        trip_source("blue", 2025, 1)
    assert resolve_month(at("2023-12-31")) == (2023, 10)
    assert resolve_month(at("2026-02-01")).label == "2025-12"
    assert resolve_month(at("2026-02-01"), Month(2019, 5)).label == "2019-05"
    for wrong in (Month(2024, None), Month(2024, True), Month(2024, 1.0), Month(24, 1)):
        with pytest.raises(ValueError):
            resolve_month(at("2026-02-01"), wrong)
