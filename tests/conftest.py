import datetime as dt
import os
import shutil
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fareledger.session import local_session
from fareledger.sources.schemas import GREEN, YELLOW
from fareledger.sources.tables import Warehouse

ARROW = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "string": pa.large_string(),
    "timestamp_ntz": pa.timestamp("us"),
}


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    # Fixtures are a few rows: planning and compiling would be all the time they take.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def at(text):
    return dt.datetime.fromisoformat(text) if text else None


def arrow_schema(fields):
    return pa.schema([pa.field(name, ARROW[kind]) for name, kind in fields])


def write_rows(path, fields, rows, row_group_size=2):
    path.parent.mkdir(parents=True, exist_ok=True)
    names = [name for name, _ in fields]
    table = pa.table(
        {n: pa.array([r.get(n) for r in rows], type=ARROW[k]) for n, k in fields},
        schema=arrow_schema(fields),
    )
    assert table.column_names == names
    pq.write_table(table, path, row_group_size=row_group_size)


def row(names, values):
    return dict(zip(names, values, strict=True))


# An ordinary trip, a refunded one that ends before it starts, and one of unknown codes and time.
YELLOW_ROWS = [
    row(YELLOW.names, [6, at("2025-01-18 17:42:10"), at("2025-01-18 18:03:55"), 2, 3.7, 1, "N", 11, 12, 2,
                       17.25, 2.5, .5, 0.0, 6.94, 1.0, 31.19, 2.5, 0.0, .5]),
    row(YELLOW.names, [7, at("2025-01-23 06:05:00"), at("2025-01-23 05:58:30"), None, 0.0, None, None,
                       12, 11, 1, -8.6, 0.0, -.5, 0.0, 0.0, -1.0, -10.1, None, None, None]),
    row(YELLOW.names, [41, None, at("2025-01-30 22:11:00"), 4, 12.25, 57, "Y", 777, 778, 8, 48.0, 0.0,
                       .5, 9.6, 0.0, 1.0, 63.85, 2.5, 1.75, .5]),
]
YELLOW_LATER = [
    YELLOW_ROWS[0] | {"tpep_pickup_datetime": at("2025-02-09 12:20:30"),
                      "tpep_dropoff_datetime": at("2025-02-09 12:41:00"), "payment_type": 1},
    YELLOW_ROWS[1] | {"tpep_pickup_datetime": at("2025-02-17 19:30:00"),
                      "tpep_dropoff_datetime": at("2025-02-17 19:52:15"), "trip_distance": 4.4},
]
GREEN_ROWS = [
    row(GREEN.names, [1, at("2025-01-04 13:15:00"), at("2025-01-04 13:47:20"), "N", 5, 12, 12, 3, 8.8, 31.0,
                      0.0, .5, 6.2, 0.0, None, 1.0, 38.7, 1, 2, 0.0, 0.0]),
    row(GREEN.names, [6, at("2025-01-12 00:30:45"), at("2025-01-12 00:31:00"), "Y", 1, 11, 777, None, 0.1, 3.0,
                      1.0, .5, 0.0, 0.0, None, 1.0, 5.5, 2, 1, 0.0, 0.0]),
    row(GREEN.names, [2, at("2025-01-27 08:00:00"), at("2025-01-27 08:25:00"), "N", 1, 12, 11, 1, 5.5, -21.0,
                      0.0, -.5, 0.0, 0.0, None, -1.0, -22.5, 4, 1, 0.0, None]),
]
ZONE_CSV = (
    "LocationID,Borough,Zone,service_zone\n"
    "11,North Shore,\"Quarry Lane, upper end\",Outer\n12,Harbour,Pier Nine,Inner\n"
)


@pytest.fixture
def landing(tmp_path):
    """Landing folder with one yellow month, one green month and the zone lookup."""
    root = tmp_path / "feed"
    write_rows(root / "data/landing/yellow/2025/01.parquet", YELLOW.fields, YELLOW_ROWS)
    write_rows(root / "data/landing/green/2025/01.parquet", GREEN.fields, GREEN_ROWS)
    zones = root / "data/landing/reference/taxi_zone_lookup.csv"
    zones.parent.mkdir(parents=True)
    zones.write_text(ZONE_CSV, encoding="utf-8")
    return root


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
