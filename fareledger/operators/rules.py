"""Quality rules as data: name, severity, how it is evaluated and on which column."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.functions.columns import outside_month
from fareledger.session import literal_table

INFO, WARNING, ERROR = "INFO", "WARNING", "ERROR"
SCALAR, DOMAIN, REFERENCE, DUPLICATE = "scalar", "domain", "reference", "duplicate"


@dataclass(frozen=True)
class Rule:
    """One check. Scalar rules carry a condition, the other kinds a column or nothing."""

    name: str
    severity: str
    kind: str = SCALAR
    column: str | None = None
    allowed: tuple = ()
    condition: Callable[[], Column] | None = None


def scalar(name: str, severity: str, condition: Callable[[], Column]) -> Rule:
    return Rule(name, severity, condition=condition)


def negative(column: str, name: str | None = None) -> Rule:
    return scalar(f"negative_{name or column}", WARNING, lambda: F.col(column) < 0)


def zero(column: str) -> Rule:
    return scalar(f"zero_{column}", INFO, lambda: F.col(column) == 0)


def missing(column: str, name: str) -> Rule:
    return scalar(f"{name}_null_rate", INFO, lambda: F.col(column).isNull())


def domain(name: str, column: str, allowed: Sequence) -> Rule:
    return Rule(name, WARNING, DOMAIN, column, tuple(allowed))


def reference(name: str, column: str) -> Rule:
    return Rule(name, WARNING, REFERENCE, column)


# Documented code domains.
VENDOR_IDS = (1, 2, 6, 7)
RATE_CODES = (1, 2, 3, 4, 5, 6, 99)
FLAGS = ("N", "Y")
YELLOW_PAYMENTS = (0, 1, 2, 3, 4, 5)
GREEN_PAYMENTS = (1, 2, 3, 4, 5, 6)
TRIP_TYPES = (1, 2)


def rule_catalog(dataset: str) -> list[Rule]:
    """Rules of a trip dataset in reporting order."""
    if dataset not in ("yellow_tripdata", "green_tripdata"):
        raise ValueError(f"Unsupported quality dataset: {dataset}")
    yellow = dataset == "yellow_tripdata"
    prefix = "tpep" if yellow else "lpep"
    pickup, dropoff = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    rules = [
        scalar("pickup_outside_source_month", WARNING,
               lambda: outside_month(pickup, "_source_year", "_source_month")),
        scalar("dropoff_before_pickup", WARNING, lambda: F.col(dropoff) < F.col(pickup)),
        negative("trip_distance"),
        negative("fare_amount"),
        negative("total_amount"),
        negative("extra"),
        negative("mta_tax"),
        negative("tip_amount"),
        negative("tolls_amount"),
        negative("improvement_surcharge"),
        negative("congestion_surcharge"),
    ]
    if yellow:
        rules.append(negative("Airport_fee", "airport_fee"))
    rules += [
        negative("cbd_congestion_fee"),
        zero("trip_distance"),
        zero("passenger_count"),
        missing("passenger_count", "passenger_count"),
        missing("RatecodeID", "rate_code"),
        missing("store_and_fwd_flag", "store_and_fwd"),
        missing("congestion_surcharge", "congestion_surcharge"),
    ]
    if yellow:
        rules.append(missing("Airport_fee", "airport_fee"))
    rules += [
        domain("unexpected_vendor_id", "VendorID", VENDOR_IDS),
        domain("unexpected_rate_code", "RatecodeID", RATE_CODES),
        domain("unexpected_store_and_fwd_flag", "store_and_fwd_flag", FLAGS),
        domain("unexpected_payment_type", "payment_type",
               YELLOW_PAYMENTS if yellow else GREEN_PAYMENTS),
        reference("unknown_pickup_zone", "PULocationID"),
        reference("unknown_dropoff_zone", "DOLocationID"),
        Rule("exact_duplicate_source_rows", WARNING, DUPLICATE),
    ]
    if not yellow:
        rules += [
            negative("ehail_fee"),
            missing("ehail_fee", "ehail_fee"),
            domain("unexpected_trip_type", "trip_type", TRIP_TYPES),
        ]
    return rules


def of_kind(rules: Sequence[Rule], kind: str) -> list[Rule]:
    return [rule for rule in rules if rule.kind == kind]


def catalog_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The catalog as a few literal rows."""
    return literal_table(
        spark,
        [(i, r.name, r.severity, r.kind, r.column) for i, r in enumerate(rules, 1)],
        "ordinal int, check_name string, severity string, kind string, column_name string",
    )
