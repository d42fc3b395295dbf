"""File-version registry: registration, decisions, storage records and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.functions.ranks import number_rows
from fareledger.sources.schemas import (
    ALREADY_LOADED,
    BLOCKED,
    LOADED,
    PROCEED,
    READY,
    REVISION,
    SUCCEEDED,
    ZONE_PARTITION,
)

VERSION_COLUMNS = (
    "dataset_name", "service_type", "source_year", "source_month", "partition_key",
    "source_url", "landing_path", "checksum_sha256", "file_size_bytes", "row_count",
    "schema_fingerprint",
)


class StateError(ValueError):
    """An operational status or transition is not allowed."""


def raise_if_any(violations: DataFrame, column: str = "problem") -> None:
    """Raise the first violation; only one row reaches the driver."""
    found = violations.select(column).limit(1).collect()
    if found:
        raise StateError(found[0][0])


def decide(status: Column | str) -> Column:
    """What to do with a registered version; an unknown status is an error."""
    status = F.col(status) if isinstance(status, str) else status
    return (
        F.when(status == READY, F.lit(PROCEED))
        .when(status == LOADED, F.lit(ALREADY_LOADED))
        .when(status == REVISION, F.lit(BLOCKED))
        .otherwise(F.raise_error(F.concat(F.lit("Unknown source status: "), status)))
    )


def current_sources(registrations: DataFrame, runs: DataFrame) -> DataFrame:
    """Registered versions with their effective status.

    A ready version counts as loaded from the moment the run log has a succeeded run for it.
    """
    done = (
        runs.where((F.col("status") == SUCCEEDED) & F.col("source_file_id").isNotNull())
        .groupBy("source_file_id")
        .agg(F.lit(True).alias("_done"), F.min("finished_at").alias("_done_at"))
    )
    joined = registrations.join(done, "source_file_id", "left")
    loaded = (F.col("status") == READY) & F.col("_done").isNotNull()
    return joined.select(*[
        F.when(loaded, F.lit(LOADED)).otherwise(F.col("status")).alias("status")
        if name == "status"
        else F.coalesce("loaded_at", "_done_at").alias("loaded_at") if name == "loaded_at"
        else F.col(name)
        for name in registrations.columns
    ])


def refused(manifest: DataFrame) -> DataFrame:
    """Versions that may not be registered at all."""
    return manifest.where(~F.coalesce(F.col("file_size_bytes") > 0, F.lit(False)))


def register(manifest: DataFrame, registry: DataFrame, arrival: str = "partition_key") -> DataFrame:
    """Registration outcome of every distinct version in ``manifest``.

    A known (partition, checksum) keeps its id and status. Otherwise the first version of an
    unknown partition is ready and any other is a revision; ids continue after the largest
    known one in arrival order. A version of no or unknown size is an error; ``refused`` lists
    them beforehand. First arrivals are found by partial aggregates, so a
    partition with a large share of all versions is never gathered in one task.
    """
    # Part of the filter, so that no plan can prune the refusal away.
    sized = F.when(F.coalesce(F.col("file_size_bytes") > 0, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("refused, a version without bytes: "), "partition_key"))
        .cast("boolean"))
    versions = (
        manifest.where(sized)
        .groupBy("partition_key", "checksum_sha256")
        .agg(F.min(F.struct(
            F.col(arrival).alias("_arrival"),
            *[F.col(c) for c in VERSION_COLUMNS if c not in ("partition_key", "checksum_sha256")],
        )).alias("_v"))
        .select("partition_key", "checksum_sha256", "_v.*")
    )
    known = registry.select(
        "partition_key", "checksum_sha256",
        F.col("source_file_id").alias("_id"), F.col("status").alias("_status"),
    )
    matched = versions.join(known, ["partition_key", "checksum_sha256"], "left")
    reused = matched.where(F.col("_id").isNotNull()).select(
        *VERSION_COLUMNS, F.col("_id").alias("source_file_id"), F.col("_status").alias("status"),
        F.lit(False).alias("is_new"),
    )
    fresh = number_rows(
        matched.where(F.col("_id").isNull()).select(*VERSION_COLUMNS, "_arrival"),
        "_arrival", "partition_key", "checksum_sha256",
        name="_n",
    )
    last = registry.agg(F.max("source_file_id")).first()[0] or 0
    seen = registry.groupBy("partition_key").agg(F.lit(True).alias("_seen"))
    first = fresh.groupBy("partition_key").agg(F.min("_n").alias("_first"))
    created = (
        fresh.join(first, "partition_key").join(seen, "partition_key", "left")
        .select(
            *VERSION_COLUMNS,
            (F.col("_n") + last).alias("source_file_id"),
            F.when(F.col("_seen").isNotNull() | (F.col("_n") > F.col("_first")), F.lit(REVISION))
            .otherwise(F.lit(READY)).alias("status"),
            F.lit(True).alias("is_new"),
        )
    )
    return reused.unionByName(created).withColumn("decision", decide("status"))


def registration_rows(outcome: DataFrame, validated_at) -> DataFrame:
    """New registrations in the shape of the stored registry."""
    from fareledger.sources.readers import align_columns
    from fareledger.sources.schemas import SOURCE_FILES

    rows = outcome.where("is_new").select(
        "*", F.lit(validated_at).cast("timestamp").alias("validated_at"),
        F.lit("local").alias("storage_backend"),
    )
    return align_columns(rows, SOURCE_FILES)


def latest_version(registry: DataFrame) -> DataFrame:
    """Highest version id of every partition."""
    return registry.groupBy("partition_key").agg(F.max("source_file_id").alias("source_file_id"))


def active_zone_source(
    registry: DataFrame, zones: DataFrame, partition: str = ZONE_PARTITION,
    dataset: str = "taxi_zone_lookup",
) -> DataFrame:
    """The newest loaded lookup version with its row count; no row when none is usable.

    Newest means the latest load time, unknown times last, then the highest id.
    """
    newest = (
        registry.where((F.col("dataset_name") == dataset) & (F.col("status") == LOADED))
        .agg(F.max(F.struct("loaded_at", "source_file_id")).alias("_top"))
        .select(F.col("_top.source_file_id").alias("source_file_id"))
        .where(F.col("source_file_id").isNotNull())
    )
    counts = zones.groupBy(F.col("_source_file_id").alias("source_file_id")).agg(
        F.count("*").alias("zone_count")
    )
    return newest.join(counts, "source_file_id")


def list_sources(
    registry: DataFrame, service_type: str | None = None, status: str | None = None,
    year: int | None = None, month: int | None = None, limit: int = 50, offset: int = 0,
) -> DataFrame:
    """Page of registered versions, newest id first."""
    filters = {"service_type": service_type, "status": status, "source_year": year,
               "source_month": month}
    for name, wanted in filters.items():
        if wanted is not None:
            registry = registry.where(F.col(name) == wanted)
    return registry.orderBy(F.col("source_file_id").desc()).offset(offset).limit(limit)


def get_one(df: DataFrame, key: str, value, label: str) -> DataFrame:
    """The row with ``key`` = ``value``; an unknown key is an error."""
    found = df.where(F.col(key) == value)
    if found.isEmpty():
        raise StateError(f"Unknown {label}: {value}")
    return found


def get_source(registry: DataFrame, source_file_id: int) -> DataFrame:
    return get_one(registry, "source_file_id", source_file_id, "source file ID")


def merge_storage(registry: DataFrame, updates: DataFrame) -> DataFrame:
    """Overwrite storage columns, but never let a local record erase a durable one."""
    names = ["storage_backend", "storage_uri", "storage_version_id", "stored_at"]
    new = updates.select(
        "source_file_id", F.lit(True).alias("_given"), *[F.col(n).alias(f"_{n}") for n in names]
    )
    durable = (
        (F.col("_storage_backend") == "local")
        & (F.col("storage_backend") == "s3")
        & F.col("storage_uri").isNotNull()
    )
    keep = F.col("_given").isNull() | F.coalesce(durable, F.lit(False))
    return registry.join(new, "source_file_id", "left").select(*[
        F.when(keep, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) if c in names else F.col(c)
        for c in registry.columns
    ])


def integrity_audit(observed: DataFrame, registry: DataFrame, on: str = "partition_key") -> DataFrame:
    """Compare observed files with their registered identity, one verdict per key."""
    facts = ["dataset_name", "checksum_sha256", "file_size_bytes", "storage_version_id"]

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            on, F.lit(True).alias(f"_{tag}"),
            *[
                (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(f"_{tag}_{c}")
                for c in facts
            ],
        )

    both = side(observed, "o").join(side(registry, "r"), on, "full_outer")
    differs = F.lit(False)
    for c in facts[:3]:
        differs = differs | ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_r_{c}"))
    version = F.coalesce(
        F.col("_o_storage_version_id") != F.col("_r_storage_version_id"), F.lit(False)
    )
    return both.select(
        on,
        F.when(F.col("_o").isNull(), F.lit("missing"))
        .when(F.col("_r").isNull(), F.lit("unregistered"))
        .when(differs | version, F.lit("conflict"))
        .otherwise(F.lit("ok")).alias("verdict"),
        F.col("_r_checksum_sha256").alias("registered_checksum"),
        F.col("_o_checksum_sha256").alias("observed_checksum"),
    )


def loaded_date_bounds(registry: DataFrame, services: tuple[str, ...] = ("yellow", "green")) -> DataFrame:
    """First and last day covered by the registered months of loaded versions."""
    month = F.make_date(
        F.col("source_year").cast("int"), F.col("source_month").cast("int"), F.lit(1)
    )
    return registry.where(
        (F.col("status") == LOADED) & F.col("service_type").isin(*services)
        & F.col("source_year").isNotNull() & F.col("source_month").isNotNull()
    ).agg(F.min(month).alias("first_day"), F.last_day(F.max(month)).alias("last_day"))
