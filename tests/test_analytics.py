from datetime import date

import pytest

from fareledger.plans import analytics
from fareledger.session import literal_table
from tests.conftest import rows


@pytest.fixture
def star(spark):
    dates = literal_table(
        spark,
        [(0, None), (20231130, date(2023, 11, 30)), (20231204, date(2023, 12, 4)),
         (20231231, date(2023, 12, 31))],
        "date_key int, full_date date",
    )
    zones = literal_table(
        spark, [(0, None, "Unknown", "Unknown"), (7, 70, "North", "Quay"), (9, 90, "South", "Mill")],
        "zone_key int, location_id int, borough string, zone_name string",
    )
    facts = literal_table(
        spark,
        [("green", 20231130, 9, 1.5, 6., 0., 7.5), ("green", 20231204, 9, 2.5, 9., 3., 13.25),
         ("green", 20231231, 7, 8., 21., 6., 30.), ("green", 0, 0, 0., 3., 0., 3.25),
         ("yellow", 20231204, 7, 5., 16., 2., 20.)],
        "service_type string, pickup_date_key int, pickup_zone_key int, "
        "trip_distance_miles double, fare_amount double, tip_amount double, total_amount double",
    )
    return facts, dates, zones


def test_summary(star):
    facts, dates, _ = star
    got = rows(analytics.summary(facts, dates, service_type="green"))[0]
    assert got["trip_count"] == 4 and got["total_amount"] == pytest.approx(54.0)
    assert got["average_trip_distance_miles"] == pytest.approx(3.0)
    assert got["average_fare_amount"] == pytest.approx(9.75)
    assert got["average_tip_amount"] == pytest.approx(2.25)
    none = rows(analytics.summary(facts, dates, start=date(2030, 1, 1)))[0]
    assert none["trip_count"] == 0 and none["total_amount"] is None


def test_bounds_drop_the_unknown_date(star):
    facts, dates, _ = star
    count = lambda **b: rows(analytics.summary(facts, dates, **b))[0]["trip_count"]
    assert count() == 5
    assert count(end=date(2024, 1, 1)) == 4
    assert count(start=date(2023, 1, 1)) == 4
    assert count(start=date(2023, 12, 4), end=date(2023, 12, 4)) == 2
    assert count(start=date(2023, 12, 1), service_type="green") == 2
    with pytest.raises(ValueError, match="start_date"):
        count(start=date(2024, 2, 1), end=date(2023, 1, 1))


def test_monthly_puts_the_unknown_month_last(star):
    facts, dates, _ = star
    got = [(r["month"], r["service_type"], r["trip_count"]) for r in rows(analytics.monthly(facts, dates))]
    assert got == [
        (date(2023, 11, 1), "green", 1), (date(2023, 12, 1), "green", 2),
        (date(2023, 12, 1), "yellow", 1), (None, "green", 1),
    ]


def test_top_zones_and_labels(star):
    facts, dates, zones = star
    top = analytics.top_zones(facts, dates, zones)
    assert [(r["location_id"], r["trip_count"], r["total_amount"]) for r in rows(top)] == [
        (70, 2, 50.0), (90, 2, 20.75), (None, 1, 3.25)]
    assert [r["label"] for r in rows(analytics.zone_labels(top))][:2] == ["North · Quay", "South · Mill"]
    assert len(rows(analytics.top_zones(facts, dates, zones, limit=1))) == 1
    for limit in (0, 101):
        with pytest.raises(ValueError):
            analytics.top_zones(facts, dates, zones, limit=limit)


def test_pivot_and_share(star):
    facts, dates, _ = star
    months = analytics.monthly(facts, dates)
    pivot = {r["month"]: r for r in rows(analytics.monthly_pivot(months, "trip_count", ["green", "yellow"]))}
    assert pivot["Unknown"] == {"month": "Unknown", "green": 1, "yellow": None}
    assert pivot["2023-12-01"]["yellow"] == 1
    share = {r["service_type"]: r for r in rows(analytics.service_share(months))}
    assert share["green"]["trip_count"] == 4 and share["green"]["share"] == 0.8
