"""Fixed source contracts and the Spark schemas of every stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Ordered source columns and their types, as published for the feeds.
YELLOW_BASELINE = (
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "bigint"),
    ("trip_distance", "double"),
    ("RatecodeID", "bigint"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("Airport_fee", "double"),
)
YELLOW_ADDED = (("cbd_congestion_fee", "double"),)
GREEN_BASELINE = (
    ("VendorID", "int"),
    ("lpep_pickup_datetime", "timestamp_ntz"),
    ("lpep_dropoff_datetime", "timestamp_ntz"),
    ("store_and_fwd_flag", "string"),
    ("RatecodeID", "bigint"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("passenger_count", "bigint"),
    ("trip_distance", "double"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("ehail_fee", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("payment_type", "bigint"),
    ("trip_type", "bigint"),
    ("congestion_surcharge", "double"),
    ("cbd_congestion_fee", "double"),
)
ZONE_FIELDS = (
    ("LocationID", "int"),
    ("Borough", "string"),
    ("Zone", "string"),
    ("service_zone", "string"),
)
ARROW_TYPES = {
    "int": "int32",
    "bigint": "int64",
    "double": "double",
    "string": "large_string",
    "timestamp_ntz": "timestamp[us]",
}
LINEAGE = (
    ("_source_file_id", "bigint"),
    ("_source_row_number", "bigint"),
    ("_pipeline_run_id", "bigint"),
    ("_ingested_at", "timestamp"),
)


SPARK_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, SPARK_TYPES[kind]) for name, kind in fields])


@dataclass(frozen=True)
class Contract:
    """Ordered columns a service must deliver, plus columns it may add at the end."""

    service: str
    baseline: tuple[tuple[str, str], ...]
    added: tuple[tuple[str, str], ...] = ()
    base_version: str = ""
    added_version: str = ""

    @property
    def fields(self) -> tuple[tuple[str, str], ...]:
        return self.baseline + self.added

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def schema(self) -> T.StructType:
        return struct(self.fields)

    @property
    def raw_schema(self) -> T.StructType:
        return struct(self.fields + LINEAGE)


YELLOW = Contract("yellow", YELLOW_BASELINE, YELLOW_ADDED, "yellow_v1", "yellow_v2")
GREEN = Contract("green", GREEN_BASELINE, base_version="green_v1")
ZONES = Contract("zones", ZONE_FIELDS)
CONTRACTS = {"yellow_tripdata": YELLOW, "green_tripdata": GREEN, "taxi_zone_lookup": ZONES}
TRIP_CONTRACTS = {name: c for name, c in CONTRACTS.items() if c is not ZONES}
ZONE_PARTITION = "reference/taxi_zones"

# Status vocabularies.
READY, LOADED, REVISION = "ready", "loaded", "revision_detected"
RUNNING, SUCCEEDED, FAILED, SKIPPED = "running", "succeeded", "failed", "skipped"
PROCEED, ALREADY_LOADED, BLOCKED = "proceed", "already_loaded", "source_revision_blocked"
SOURCE_REVISION = "source_revision_detected"

SOURCE_FILES = struct((
    ("source_file_id", "bigint"), ("dataset_name", "string"), ("service_type", "string"),
    ("source_year", "smallint"), ("source_month", "smallint"), ("partition_key", "string"),
    ("source_url", "string"), ("landing_path", "string"), ("checksum_sha256", "string"),
    ("file_size_bytes", "bigint"), ("row_count", "bigint"), ("schema_fingerprint", "string"),
    ("status", "string"), ("discovered_at", "timestamp"), ("downloaded_at", "timestamp"),
    ("validated_at", "timestamp"), ("loaded_at", "timestamp"), ("storage_backend", "string"),
    ("storage_uri", "string"), ("storage_version_id", "string"), ("stored_at", "timestamp"),
))
PIPELINE_RUNS = struct((
    ("run_id", "bigint"), ("dataset_name", "string"), ("service_type", "string"),
    ("source_year", "smallint"), ("source_month", "smallint"), ("source_file_id", "bigint"),
    ("started_at", "timestamp"), ("finished_at", "timestamp"), ("status", "string"),
    ("status_reason", "string"), ("rows_read", "bigint"), ("rows_loaded", "bigint"),
    ("warning_count", "int"), ("error_count", "int"), ("error_message", "string"),
))
RUN_EVENTS = T.StructType([*PIPELINE_RUNS.fields, T.StructField("event_seq", T.IntegerType())])
QUALITY_RESULTS = struct((
    ("quality_result_id", "bigint"), ("run_id", "bigint"), ("check_name", "string"),
    ("severity", "string"), ("status", "string"), ("rows_checked", "bigint"),
    ("rows_failed", "bigint"), ("failure_rate", "double"), ("details", "string"),
    ("executed_at", "timestamp"),
))
QUALITY_VALUES = struct((
    ("run_id", "bigint"), ("check_name", "string"), ("int_value", "bigint"),
    ("text_value", "string"), ("count", "bigint"),
))
CANONICAL = struct((
    ("service_type", "string"), ("vendor_id", "int"), ("pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "timestamp_ntz"), ("passenger_count", "bigint"),
    ("trip_distance_miles", "double"), ("rate_code_id", "bigint"),
    ("store_and_fwd_flag", "string"), ("pickup_location_id", "int"),
    ("dropoff_location_id", "int"), ("payment_type", "bigint"), ("trip_type", "bigint"),
    ("fare_amount", "double"), ("extra_amount", "double"), ("mta_tax_amount", "double"),
    ("tip_amount", "double"), ("tolls_amount", "double"),
    ("improvement_surcharge_amount", "double"), ("congestion_surcharge_amount", "double"),
    ("airport_fee_amount", "double"), ("cbd_congestion_fee_amount", "double"),
    ("total_amount", "double"), ("source_file_id", "bigint"), ("source_row_number", "bigint"),
    ("pipeline_run_id", "bigint"), ("ingested_at", "timestamp"),
))
