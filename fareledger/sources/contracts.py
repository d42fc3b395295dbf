"""Structural contracts checked on file schemas, and comparisons between schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareledger.session import literal_table
from fareledger.sources.schemas import ARROW_TYPES, TRIP_CONTRACTS, ZONE_FIELDS, Contract

# Cell texts that the profiler and the contract read as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def contract_rows(
    spark: SparkSession, contracts: dict[str, Contract] = TRIP_CONTRACTS,
    arrow_types: dict[str, str] = ARROW_TYPES,
) -> DataFrame:
    """The contracts as one literal row per dataset and expected column."""
    rows = []
    for dataset, contract in contracts.items():
        for i, (name, kind) in enumerate(contract.fields):
            rows.append((
                dataset, name, i, arrow_types.get(kind, kind), i >= len(contract.baseline),
                contract.base_version, contract.added_version or None, contract.service.title(),
            ))
    return literal_table(
        spark, rows,
        "dataset_name string, name string, expected_position int, expected_type string, "
        "additive boolean, base_version string, added_version string, label string",
    )


def contract_differences(
    fields: DataFrame, datasets: DataFrame, contracts: dict[str, Contract] = TRIP_CONTRACTS,
    arrow_types: dict[str, str] = ARROW_TYPES,
) -> DataFrame:
    """One row per file and column that is expected, delivered or both.

    ``fields`` is the footer listing and ``datasets`` names the dataset of each path.
    """
    expected = contract_rows(fields.sparkSession, contracts, arrow_types)
    wanted = datasets.select("path", "dataset_name").join(expected, "dataset_name")
    found = fields.join(datasets.select("path", "dataset_name"), "path").join(
        expected.select("dataset_name").distinct(), "dataset_name", "left_semi"
    )
    keys = ["path", "dataset_name", "name"]
    return wanted.join(
        found.select(*keys, "ordinal_position", "arrow_type", "nullable"), keys, "full_outer"
    )


def validate_contract(
    fields: DataFrame, datasets: DataFrame, contracts: dict[str, Contract] = TRIP_CONTRACTS,
    arrow_types: dict[str, str] = ARROW_TYPES,
) -> DataFrame:
    """Per path: the schema version it satisfies, or the first problem found.

    Problems are looked for in the order missing, unknown, column order, type, nullability.
    """
    pairs = contract_differences(fields, datasets, contracts, arrow_types)
    by_file = Window.partitionBy("path")
    present = F.col("ordinal_position").isNotNull()
    # A file has as many rows here as columns, so its window is a handful of rows.
    delivered_rank = F.row_number().over(
        by_file.orderBy(F.col("ordinal_position").asc_nulls_last())
    )
    expected_rank = F.row_number().over(
        by_file.orderBy((~present).cast("int"), F.col("expected_position").asc_nulls_last())
    )
    ranked = pairs.select(
        "*", present.alias("_present"), delivered_rank.alias("_d"), expected_rank.alias("_e")
    )

    def names(condition, position) -> F.Column:
        chosen = F.sort_array(F.collect_list(F.when(condition, F.struct(position, "name"))))
        return F.array_join(F.transform(chosen, lambda s: s["name"]), ", ")

    known = F.col("expected_position").isNotNull()
    first_type = F.min(F.when(
        F.col("_present") & known & (F.col("arrow_type") != F.col("expected_type")),
        F.struct("ordinal_position", "name", "expected_type", "arrow_type"),
    ))
    first_null = F.min(
        F.when(F.col("_present") & known & ~F.col("nullable"), F.struct("ordinal_position", "name"))
    )
    summary = ranked.groupBy("path").agg(
        F.max("label").alias("_label"),
        names(known & ~F.col("_present") & ~F.col("additive"), "expected_position").alias("_miss"),
        names(F.col("_present") & ~known, "ordinal_position").alias("_extra"),
        F.count_if(F.col("_present") & (F.col("_d") != F.col("_e"))).alias("_moved"),
        first_type.alias("_type"),
        first_null.alias("_null"),
        F.max("base_version").alias("_base"),
        F.max("added_version").alias("_plus"),
        F.coalesce(F.bool_or(F.col("_present") & F.col("additive")), F.lit(False)).alias("_has"),
    )
    problem = (
        F.when(F.col("_miss") != "", F.concat(
            F.lit("Missing baseline "), "_label", F.lit(" fields: "), "_miss"))
        .when(F.col("_extra") != "", F.concat(
            F.lit("Unsupported "), "_label", F.lit(" fields: "), "_extra"))
        .when(F.col("_moved") > 0, F.concat(
            F.lit("Unsupported "), "_label", F.lit(" source column order")))
        .when(F.col("_type").isNotNull(), F.concat(
            F.lit("Unsupported type for "), "_type.name", F.lit(": expected "),
            "_type.expected_type", F.lit(", got "), "_type.arrow_type"))
        .when(F.col("_null").isNotNull(), F.concat(
            F.lit("Unsupported nullability for "), "_null.name", F.lit(": expected nullable")))
    )
    version = F.when(F.col("_has"), F.col("_plus")).otherwise(F.col("_base"))
    return summary.select("path", problem.alias("contract_problem"), version.alias("_version")).select(
        "path",
        F.when(F.col("contract_problem").isNull(), F.col("_version")).alias("schema_version"),
        "contract_problem",
    )


def missing_text(column: str) -> F.Column:
    """The cell, or null where its text stands for a missing value."""
    value = F.col(column).cast("string")
    return F.when(~value.isin(*NA_TOKENS), value)


def validate_zones(
    zones: DataFrame, columns: Iterable[str], key: str = "LocationID",
    required: Iterable[str] = tuple(name for name, _ in ZONE_FIELDS),
) -> DataFrame:
    """Row count of a lookup file and its first problem; ``columns`` is the file's header."""
    columns, required = list(columns), list(required)
    missing = [name for name in required if name not in columns]
    unknown = [name for name in columns if name not in required]
    fixed = None
    if missing:
        fixed = f"Missing Taxi Zone fields: {', '.join(missing)}"
    elif unknown:
        fixed = f"Unsupported Taxi Zone fields: {', '.join(unknown)}"
    if fixed:
        return zones.agg(F.count("*").alias("row_count")).withColumn("problem", F.lit(fixed))
    counts = zones.groupBy(missing_text(key).alias("_key")).agg(F.count("*").alias("_n"))
    facts = counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("_nulls"),
        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_repeated"),
    )
    problem = (
        F.when(F.col("row_count") == 0, F.lit("Taxi Zone source is empty"))
        .when(F.col("_nulls") > 0, F.lit(f"Taxi Zone {key} contains null values"))
        .when(F.col("_repeated") > 0, F.lit(f"Taxi Zone {key} contains duplicate values"))
    )
    return facts.select("row_count", problem.alias("problem"))


def compare_schemas(left: DataFrame, right: DataFrame) -> DataFrame:
    """Differences of two footer listings, one row per column of either side.

    ``presence`` is common, only_left or only_right; the order columns rank the common
    columns on each side, and ``order_differs`` says whether any rank differs.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            "name",
            F.col("ordinal_position").alias(f"{tag}_position"),
            F.col("arrow_type").alias(f"{tag}_type"),
            F.col("nullable").alias(f"{tag}_nullable"),
        )

    both = side(left, "left").join(side(right, "right"), "name", "full_outer")
    common = F.col("left_position").isNotNull() & F.col("right_position").isNotNull()
    marked = both.select(
        "*",
        F.when(common, F.lit("common"))
        .when(F.col("left_position").isNotNull(), F.lit("only_left"))
        .otherwise(F.lit("only_right")).alias("presence"),
        (common & ~F.col("left_type").eqNullSafe(F.col("right_type"))).alias("type_differs"),
        (common & ~F.col("left_nullable").eqNullSafe(F.col("right_nullable")))
        .alias("nullability_differs"),
    )
    # Rows are the columns of one schema pair, so these windows hold a few hundred rows at most.
    among = Window.partitionBy("presence")
    return marked.select(
        "*",
        F.when(F.col("presence") == "common", F.row_number().over(among.orderBy("left_position")))
        .alias("left_rank"),
        F.when(F.col("presence") == "common", F.row_number().over(among.orderBy("right_position")))
        .alias("right_rank"),
    ).select(
        "*",
        F.coalesce(
            F.bool_or(F.col("left_rank") != F.col("right_rank")).over(Window.partitionBy(F.lit(1))),
            F.lit(False),
        ).alias("order_differs"),
    )


def documented_presence(fields: DataFrame, documented: Iterable[str]) -> DataFrame:
    """Whether each documented column occurs in each listed file."""
    names = F.array(*[F.lit(name) for name in documented])
    return fields.groupBy("path").agg(F.collect_set("name").alias("_names")).select(
        "path", "_names", F.posexplode(names).alias("position", "name")
    ).select("path", "position", "name", F.array_contains("_names", F.col("name")).alias("present"))
