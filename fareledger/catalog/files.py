"""File-level operators on the Parquet files of the order tables themselves."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.catalog.trips import TABLES, table
from fareledger.session import literal_table, materialize, shared_dir, spread
from fareledger.sources import contracts, manifest
from fareledger.sources.landing import parse_paths
from fareledger.sources.readers import align_columns, stamp_lineage
from fareledger.sources.schemas import Contract
from fareledger.sources.tables import write_partitions

# Expected columns of three tables; the second lacks a column and the third has a wrong type.
CONTRACTS = {
    "orders": Contract("orders", (
        ("o_orderkey", "int64"), ("o_custkey", "int64"), ("o_orderstatus", "string"),
        ("o_totalprice", "double"), ("o_orderdate", "timestamp[us]"),
    ), (("o_orderpriority", "string"),), "orders_v1", "orders_v2"),
    "supplier": Contract("supplier", (
        ("s_suppkey", "int64"), ("s_name", "string"), ("s_nationkey", "int32"),
        ("s_acctbal", "double"), ("s_phone", "string"),
    ), base_version="supplier_v1"),
    "nation": Contract("nation", (
        ("n_nationkey", "int64"), ("n_name", "string"), ("n_regionkey", "int32"),
    ), base_version="nation_v1"),
}


def paths(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> DataFrame:
    return literal_table(spark, [(f"{sf_dir}/{name}.parquet",) for name in names], "path string")


def files(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> DataFrame:
    """The files of the tables; a table is one file or a folder of them."""
    return manifest.list_files(spark, [f"{sf_dir}/{name}.parquet" for name in names], "*")


def table_name(path: str = "path") -> F.Column:
    """The table that a file is, or lies in the folder of."""
    return F.regexp_extract(path, r"([^/]+)\.parquet(?:/[^/]+)*$", 1).alias("table_name")


def table_fields(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> DataFrame:
    """Columns of every table under the table's path: once, where its files agree."""
    found = manifest.footer_stats(files(spark, sf_dir, names))
    whole = F.format_string(f"{sf_dir.replace('%', '%%')}/%s.parquet", table_name()).alias("path")
    return found.select(whole, "ordinal_position", "name", "arrow_type", "nullable").distinct()


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, checksum and footer counts of every table file."""
    return manifest.file_identity(files(spark, sf_dir)).select(
        table_name(), "file_size_bytes", "checksum_sha256", "row_count", "row_group_count",
        "column_count", "created_by",
    )


def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = manifest.file_identity(files(spark, sf_dir)).groupBy(table_name())
    return counts.agg(F.sum("row_count").alias("row_count"))


def footer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_fields(spark, sf_dir).select(
        table_name(), "ordinal_position", "name", "arrow_type", "nullable"
    )


def schema_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = table_fields(spark, sf_dir)
    return manifest.schema_fingerprint(fields).select(table_name(), "schema_fingerprint")


def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = paths(spark, sf_dir, tuple(CONTRACTS)).select(
        "path", table_name().alias("dataset_name")
    )
    fields = table_fields(spark, sf_dir, tuple(CONTRACTS))
    checked = contracts.validate_contract(fields, listed, CONTRACTS, {})
    return checked.select(table_name(), "schema_version", "contract_problem")


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer against supplier with the name prefixes taken off."""
    fields = materialize(table_fields(spark, sf_dir, ("customer", "supplier")))
    bare = fields.select(
        table_name(), F.substring_index("name", "_", -1).alias("name"), "ordinal_position",
        "arrow_type", "nullable",
    )
    return contracts.compare_schemas(
        bare.where("table_name = 'customer'"), bare.where("table_name = 'supplier'")
    )


def documented_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = table_fields(spark, sf_dir)
    return contracts.documented_presence(fields, ["doc_id", "text", "label"]).select(
        table_name(), "name", "present"
    )


def zone_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a lookup keyed by customer: the key repeats."""
    lookup = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    return contracts.validate_zones(lookup, lookup.columns, "o_custkey", lookup.columns)


def lineage_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers of every lineitem row, summarised."""
    return _stamped(spark, sf_dir).groupBy("_source_file_id", "_pipeline_run_id").agg(
        F.count("*").alias("row_count"), F.min("_source_row_number").alias("first_row"),
        F.max("_source_row_number").alias("last_row"),
        F.sum("_source_row_number").alias("row_number_sum"),
    )


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "*", F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.row_index") + 1).alias("_source_row_number"),
    )
    files = paths(spark, sf_dir, ("lineitem",)).select(
        "path", F.lit(1).alias("source_file_id"), F.lit(5).alias("run_id")
    )
    return stamp_lineage(rows, files, datetime(2025, 3, 1, tzinfo=UTC))


def append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem stored twice as the same file version: the second write replaces the first."""
    path = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"
    rows = spread(_stamped(spark, sf_dir), table(spark, sf_dir, "lineitem"))
    write_partitions(rows, path, "_source_file_id")
    write_partitions(rows, path, "_source_file_id")
    return spark.read.parquet(path).groupBy(
        F.col("_source_file_id").cast("bigint").alias("_source_file_id")
    ).agg(F.count("*").alias("row_count"), F.sum("l_quantity").alias("quantity"))


def align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the column order of customers, with the segment absent."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("party"),
    )
    return customers.unionByName(align_columns(suppliers, customers.schema))


def landing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order months as landing paths, read back; one in twelve-odd months does not exist."""
    orders = table(spark, sf_dir, "orders")
    shown = F.format_string(
        "data/landing/yellow/%04d/%02d.parquet", F.year("o_orderdate"),
        F.month("o_orderdate") + 1,
    )
    return parse_paths(orders.select("o_orderkey", shown.alias("path"))).drop("path")


QUERIES = {
    "file_manifest": file_manifest, "manifest_counts": manifest_counts,
    "footer_stats": footer_stats, "schema_fingerprint": schema_fingerprint,
    "contract_check": contract_check, "schema_drift": schema_drift,
    "documented_presence": documented_presence, "zone_contract": zone_contract,
    "lineage_stamp": lineage_stamp, "append_raw": append_raw, "align_columns": align,
    "landing_paths": landing_paths,
}

_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
_NAMES = ", ".join(f"'{t}'" for t in TABLES)
FIELDS_CTE = f"""fields AS (
  SELECT table_name, CAST(ordinal_position - 1 AS INTEGER) AS ordinal_position, column_name AS name,
         CASE data_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp[us]'
              WHEN 'FLOAT[]' THEN 'list<element: float>' ELSE data_type END AS arrow_type,
         is_nullable = 'YES' AS nullable
  FROM information_schema.columns WHERE table_name IN ({_NAMES}))"""
ORACLE = {
    "manifest_counts": _COUNTS,
    "footer_stats": f"WITH {FIELDS_CTE} SELECT * FROM fields",
    "schema_fingerprint": f"""WITH {FIELDS_CTE} SELECT table_name,
      sha256('[' || string_agg('{{"ordinal_position":' || ordinal_position || ',"name":"' || name
        || '","arrow_type":"' || arrow_type || '","nullable":' || nullable || '}}', ','
        ORDER BY ordinal_position) || ']') AS schema_fingerprint FROM fields GROUP BY 1""",
    "contract_check": f"""WITH {FIELDS_CTE}
      SELECT 'orders' AS table_name, CASE WHEN count(*) = 6 THEN 'orders_v2' END AS schema_version,
             CAST(NULL AS VARCHAR) AS contract_problem FROM fields WHERE table_name = 'orders'
      UNION ALL SELECT 'supplier', NULL, CASE WHEN count(*) FILTER (WHERE name = 's_phone') = 0
             THEN 'Missing baseline Supplier fields: s_phone' END FROM fields WHERE table_name = 'supplier'
      UNION ALL SELECT 'nation', NULL, 'Unsupported type for n_nationkey: expected int64, got '
             || max(arrow_type) FILTER (WHERE name = 'n_nationkey') FROM fields WHERE table_name = 'nation'""",
    "schema_drift": f"""WITH {FIELDS_CTE},
      l AS (SELECT *, split_part(name, '_', -1) AS bare FROM fields WHERE table_name = 'customer'),
      r AS (SELECT *, split_part(name, '_', -1) AS bare FROM fields WHERE table_name = 'supplier'),
      b AS (SELECT coalesce(l.bare, r.bare) AS name, l.ordinal_position AS left_position,
              l.arrow_type AS left_type, l.nullable AS left_nullable,
              r.ordinal_position AS right_position, r.arrow_type AS right_type,
              r.nullable AS right_nullable,
              CASE WHEN l.bare IS NULL THEN 'only_right' WHEN r.bare IS NULL THEN 'only_left'
                   ELSE 'common' END AS presence
            FROM l FULL OUTER JOIN r ON l.bare = r.bare),
      k AS (SELECT *, presence = 'common' AND left_type <> right_type AS type_differs,
              presence = 'common' AND left_nullable <> right_nullable AS nullability_differs,
              CASE WHEN presence = 'common' THEN
                CAST(row_number() OVER (PARTITION BY presence ORDER BY left_position) AS INTEGER) END AS left_rank,
              CASE WHEN presence = 'common' THEN
                CAST(row_number() OVER (PARTITION BY presence ORDER BY right_position) AS INTEGER) END AS right_rank
            FROM b)
      SELECT *, coalesce((SELECT bool_or(left_rank <> right_rank) FROM k), false) AS order_differs FROM k""",
    "documented_presence": f"""WITH {FIELDS_CTE}
      SELECT t.table_name, d.name, bool_or(coalesce(f.name = d.name, false)) AS present
      FROM (SELECT DISTINCT table_name FROM fields) AS t
      CROSS JOIN (VALUES ('doc_id'), ('text'), ('label')) AS d(name)
      LEFT JOIN fields f ON f.table_name = t.table_name AND f.name = d.name GROUP BY 1, 2""",
    "zone_contract": """SELECT count(*) AS row_count, CASE WHEN count(*) > count(DISTINCT o_custkey)
      THEN 'Taxi Zone o_custkey contains duplicate values' END AS problem FROM orders""",
    "lineage_stamp": """SELECT CAST(1 AS BIGINT) AS _source_file_id, CAST(5 AS BIGINT) AS _pipeline_run_id,
      count(*) AS row_count, CAST(1 AS BIGINT) AS first_row, count(*) AS last_row,
      CAST(count(*) * (count(*) + 1) / 2 AS BIGINT) AS row_number_sum FROM lineitem""",
    "append_raw": """SELECT CAST(1 AS BIGINT) AS _source_file_id, count(*) AS row_count,
      sum(l_quantity) AS quantity FROM lineitem""",
    "align_columns": """SELECT c_custkey AS party, c_name AS name, c_mktsegment AS segment,
      c_acctbal AS balance FROM customer
      UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    "landing_paths": """SELECT o_orderkey, 'yellow' AS service_type,
      CAST(year(o_orderdate) AS INTEGER) AS source_year, CAST(month(o_orderdate) + 1 AS INTEGER) AS source_month,
      CASE WHEN month(o_orderdate) < 12 THEN 'yellow/' || year(o_orderdate) || '/'
        || lpad(CAST(month(o_orderdate) + 1 AS VARCHAR), 2, '0') END AS partition_key FROM orders""",
}
