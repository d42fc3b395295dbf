import json

import pytest
from pyspark.sql import functions as F

from fareledger.operators import profile
from fareledger.session import literal_table
from fareledger.sources.schemas import GREEN, YELLOW
from fareledger.sources.tables import write_profile
from tests.conftest import YELLOW_ROWS, at, rows


def listed(spark, values, ddl):
    return profile.labelled(literal_table(spark, values, ddl), "month")


def test_numeric_and_nulls(spark):
    df = listed(spark, [(None,), (-2,), (0,), (2,), (10,)], "v bigint")
    got = rows(profile.numeric_profile(df, ["v"]))[0]
    assert (got["null_rate"], got["non_null_count"], got["null_count"]) == (.2, 4, 1)
    assert (got["count_lt_0"], got["count_eq_0"], got["count_gt_0"]) == (1, 1, 2)
    assert got["p50"] == 1.0 and got["minimum"] == -2 and got["maximum"] == 10
    assert rows(profile.null_summary(df, ["v"])) == [
        {"source": "month", "column": "v", "null_count": 1, "null_rate": .2}
    ]


def test_numeric_without_data_and_nan(spark):
    nan = float("nan")
    df = listed(spark, [(None, 1.0, float("inf")), (None, nan, 1.0)], "a double, b double, c double")
    got = {r["column"]: r for r in rows(profile.numeric_profile(df, ["a", "b", "c"]))}
    assert got["a"]["p50"] is None and got["a"]["minimum"] is None and got["a"]["null_rate"] == 1.0
    assert got["b"]["non_null_count"] == 2 and got["b"]["count_gt_0"] == 1
    assert got["b"]["p99"] == 1.0 and got["b"]["maximum"] == 1.0
    assert got["c"]["maximum"] is None and got["c"]["minimum"] == 1.0


def test_domain_counts_values_and_nulls(spark):
    df = listed(spark, [(1,), (None,), (9,), (1,)], "v int")
    assert {r["value"]: r["count"] for r in rows(profile.domain_profile(df, ["v"]))} == {
        "1": 2, "9": 1, None: 1
    }


def test_duration(spark):
    df = listed(spark, [
        (at("2025-01-01 10:00"), at("2025-01-01 10:00")),
        (at("2025-01-01 10:00"), at("2025-01-01 09:58:59.500000")),
        (None, at("2025-01-01 10:00")),
        (at("2025-02-01 00:00"), at("2025-02-01 00:10")),
    ], "a timestamp_ntz, b timestamp_ntz")
    got = rows(profile.duration_profile(df, "a", "b", 2025, 1))[0]
    assert got["count_eq_0"] == 1 and got["dropoff_before_pickup_count"] == 1
    assert got["either_datetime_null_count"] == 1 and got["pickup_outside_nominal_month_count"] == 1
    assert got["minimum"] == -60.5
    clocks = {r["column"]: r for r in rows(profile.datetime_profile(df, ["a", "b"]))}
    assert clocks["a"]["null_count"] == 1 and clocks["a"]["maximum"] == at("2025-02-01 00:00")


def test_reference(spark):
    df = listed(spark, [(1,), (2,), (9,), (9,), (None,)], "v int")
    zones = literal_table(spark, [(1,), (2,)], "id int")
    got = rows(profile.reference_profile(df, ["v"], zones, "id"))[0]
    assert (got["matched_count"], got["unmatched_count"], got["null_count"]) == (2, 2, 1)
    assert got["unmatched_rate_among_non_null"] == .5
    assert rows(profile.unmatched_ids(df, ["v"], zones, "id")) == [
        {"source": "month", "column": "v", "value": "9", "count": 2}
    ]


@pytest.mark.parametrize("parts", [1, 2, 3, 5])
def test_duplicates_do_not_depend_on_partitions(spark, parts):
    df = listed(spark, [(1, "x"), (1, "x"), (1, "y"), (2, "z")], "a int, b string").repartition(parts)
    assert rows(profile.duplicate_profile(df, ["a", "b"])) == [{
        "source": "month", "total_rows": 4, "unique_full_rows": 3,
        "rows_participating_in_duplicate_groups": 2, "duplicate_excess_rows": 1,
        "duplicate_groups": 1,
    }]


def test_lookup_reads_missing_texts(spark):
    zones = listed(spark, [(1, "Queens", "a", "N/A"), (2, "NA", "b", "Boro Zone"), (2, "NA", "b", "Boro Zone"),
                           (None, "", "c", "x")],
                   "LocationID int, Borough string, Zone string, service_zone string")
    parts = profile.lookup_profile(zones)
    nulls = {r["column"]: r["null_count"] for r in rows(parts["columns"])}
    assert nulls == {"LocationID": 1, "Borough": 3, "Zone": 0, "service_zone": 1}
    assert rows(parts["key"]) == [{"source": "month", "duplicate_count": 1, "unique_count": 2,
                                   "minimum": 1.0, "maximum": 2.0}]
    assert rows(parts["duplicates"])[0]["duplicate_groups"] == 1


def test_service_profile_compare_and_report(spark, tmp_path):
    ddl = ", ".join(f"{n} {k}" for n, k in YELLOW.fields)
    base = literal_table(spark, [tuple(r.values()) for r in YELLOW_ROWS], ddl)
    zones = literal_table(spark, [(11,), (12,)], "LocationID int")
    spec = profile.service_spec(YELLOW)
    assert len(spec.numerics) == 12 and len(profile.service_spec(GREEN).numerics) == 12
    both = profile.labelled(base, "jan").unionByName(
        profile.labelled(base.where("VendorID <> 41"), "feb"))
    long = profile.profile_service(both, spec, zones, "LocationID", 2025, 1)
    got = {(r["source"], r["section"], r["column"], r["metric"]): r["number"] for r in rows(long)}
    assert got["jan", "numeric", "fare_amount", "p50"] == 17.25
    assert got["jan", "numeric", "trip_duration_seconds", "count_lt_0"] == 1
    assert got["jan", "unmatched", "PULocationID", "777"] == 1
    assert got["jan", "domain", "store_and_fwd_flag", None] == 1
    assert got["feb", "duplicates", "*", "total_rows"] == 2
    delta = {(r["section"], r["column"], r["metric"]): r["delta"]
             for r in rows(profile.profile_compare(long, "jan", "feb"))}
    assert delta["duplicates", "*", "total_rows"] == -1
    write_profile(long, str(tmp_path / "a"))
    write_profile(long.repartition(5), str(tmp_path / "b"))

    def text(name):
        return [line for p in sorted((tmp_path / name).glob("part-*")) for line in p.open()]

    assert text("a") == text("b") and json.loads(text("a")[0])["source"] == "feb"


def test_inferred_types(spark):
    listed = [("a", "1", "1", "true", "1.5", None, "x", " 1", "9223372036854775808", ""),
              ("a", "-2", None, "FALSE", "1e3", None, "1", "2", "1", "1"),
              ("b", "+3", "x", None, "7", None, None, None, None, None)]
    names = ["whole", "gaps", "flag", "real", "none", "text", "blank", "huge", "empty"]
    df = literal_table(spark, listed, ", ".join(f"{n} string" for n in ["source", *names]))
    got = {(r["source"], r["column"]): (r["inferred_type"], r["read_type"])
           for r in rows(profile.inferred_types(df, names))}
    assert [got["a", n] for n in names] == [
        ("int", "int"), ("int", "double"), ("boolean", "boolean"), ("double", "double"), ("null", "double"),
        ("text", "text"), ("text", "text"), ("double", "double"), ("text", "text")]
    assert got["b", "gaps"] == ("text", "text") and got["b", "flag"] == ("null", "double")
    assert rows(profile.inferred_types(df.limit(0), names)) == []


def test_schema_section(spark):
    fields = literal_table(spark, [("jan", 0, "a", "int64", True), ("feb", 0, "a", "int32", False), ("feb", 1, "b", "string", True)],
                           "source string, ordinal_position int, name string, arrow_type string, nullable boolean")
    got = {(r["source"], r["column"], r["metric"]): r["text"] or r["number"]
           for r in rows(profile.schema_profile(fields, ["b"]))}
    assert got["jan", "a", "arrow_type"] == "int64" and got["feb", "b", "ordinal_position"] == 1.0
    assert (got["jan", "b", "documented_present"], got["feb", "b", "documented_present"]) == ("false", "true")
    delta = rows(profile.profile_compare(profile.schema_profile(fields), "jan", "feb"))
    assert {r["left_text"] for r in delta if r["metric"] == "arrow_type" and r["column"] == "a"} == {"int64"}
