"""File-level queries where a table is a folder of files instead of one."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from fareledger.catalog.trips import TABLES
from tests.conftest import rows

QUERIES = entry.queries()
CELLS = {"doc_id": pa.array([1, 2, 3]), "text": pa.array(["a", None, "c"])}


@pytest.fixture
def sf_dir(tmp_path):
    """Every table has three rows; ``documents`` is a folder of two files beside a marker."""
    whole = pa.table(CELLS)
    for name in TABLES:
        if name != "documents":
            pq.write_table(whole, tmp_path / f"{name}.parquet")
    folder = tmp_path / "documents.parquet"
    folder.mkdir()
    (folder / "_SUCCESS").touch()
    pq.write_table(whole.slice(0, 1), folder / "part-0.parquet")
    pq.write_table(whole.slice(1), folder / "part-1.parquet")
    return str(tmp_path)


def test_a_folder_counts_as_one_table(spark, sf_dir):
    found = {r["table_name"]: r["row_count"] for r in rows(QUERIES["manifest_counts"](spark, sf_dir))}
    assert found == dict.fromkeys(TABLES, 3)


def test_every_file_of_a_folder_is_in_the_manifest(spark, sf_dir):
    found = rows(QUERIES["file_manifest"](spark, sf_dir))
    assert sorted(r["row_count"] for r in found if r["table_name"] == "documents") == [1, 2]
    assert sorted(r["table_name"] for r in found) == sorted([*TABLES, "documents"])


def test_columns_of_a_folder_are_listed_once(spark, sf_dir):
    found = rows(QUERIES["footer_stats"](spark, sf_dir))
    assert sorted((r["table_name"], r["ordinal_position"], r["name"]) for r in found) == sorted(
        (t, i, name) for t in TABLES for i, name in enumerate(CELLS))
    assert len({r["schema_fingerprint"] for r in rows(QUERIES["schema_fingerprint"](spark, sf_dir))}) == 1


def test_documented_names_and_schema_sections_of_a_folder(spark, sf_dir):
    present = {(r["table_name"], r["name"]): r["present"]
               for r in rows(QUERIES["documented_presence"](spark, sf_dir))}
    assert present == {(t, n): n in CELLS for t in TABLES for n in ("doc_id", "text", "label")}
    section = [(r["source"], r["column"], r["metric"], r["number"], r["text"])
               for r in rows(QUERIES["p_schema"](spark, sf_dir))]
    ours = sorted((r[1:] for r in section if r[0] == "documents"), key=str)
    assert ours and ours == sorted((r[1:] for r in section if r[0] == "region"), key=str)
