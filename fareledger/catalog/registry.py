"""Registry and run log operators on documents, orders and events read as file versions."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.catalog.trips import table
from fareledger.functions.columns import month_lag, object_key, partition_key
from fareledger.operators import checks, quality, registry, runs
from fareledger.sources.readers import align_columns
from fareledger.sources.schemas import PIPELINE_RUNS, RUN_EVENTS, SOURCE_FILES

NOW = datetime(2025, 3, 1, tzinfo=UTC)


def service() -> Column:
    return F.when(F.col("o_orderpriority").startswith("1"), F.lit("green")).otherwise("yellow")


def status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", F.lit("loaded"))
        .when(F.col("o_orderstatus") == "O", F.lit("ready"))
        .otherwise("revision_detected")
    )


def document_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a version of its source and language, in order of its id."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("dataset_name"), F.col("lang").alias("service_type"),
        F.lit(None).cast("smallint").alias("source_year"),
        F.lit(None).cast("smallint").alias("source_month"),
        F.concat_ws("/", "source", "lang").alias("partition_key"),
        F.lit("").alias("source_url"), F.lit("").alias("landing_path"),
        F.sha2("text", 256).alias("checksum_sha256"),
        F.octet_length("text").cast("bigint").alias("file_size_bytes"),
        F.lit(1).cast("bigint").alias("row_count"),
        F.lit(None).cast("string").alias("schema_fingerprint"),
    )


def labelled_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as versions registered earlier: good ones loaded, others ready."""
    labels = table(spark, sf_dir, "labels")
    return (
        document_versions(spark, sf_dir).join(labels, "doc_id")
        .groupBy("partition_key", "checksum_sha256")
        .agg((F.min("doc_id") + 1).alias("source_file_id"), F.max("quality").alias("_quality"))
        .select(
            "partition_key", "checksum_sha256", "source_file_id",
            F.when(F.col("_quality") == 1, F.lit("loaded")).otherwise("ready").alias("status"),
        )
    )


def order_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as monthly file versions of two services."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("source_file_id"),
        F.concat(service(), F.lit("_tripdata")).alias("dataset_name"),
        service().alias("service_type"),
        F.year("o_orderdate").alias("source_year"), F.month("o_orderdate").alias("source_month"),
        partition_key(service(), F.year("o_orderdate"), F.month("o_orderdate")).alias("partition_key"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("checksum_sha256"),
        F.floor("o_totalprice").alias("file_size_bytes"),
        status().alias("status"),
        F.when(F.col("o_custkey") >= 100, F.lit("s3")).otherwise("local").alias("storage_backend"),
        F.when(F.col("o_custkey") >= 100, F.concat(F.lit("s3://archive/"), "o_orderkey"))
        .alias("storage_uri"),
    )
    return align_columns(rows, SOURCE_FILES)


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs from order date to last ship date, their lines as the rows loaded."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("_lines"), F.max("l_shipdate").alias("_shipped"),
        F.count_if(F.col("l_returnflag") == "R").alias("_returned"),
    )
    orders = table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus") != "O"
    rows = orders.join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(service(), F.lit("_tripdata")).alias("dataset_name"),
        service().alias("service_type"),
        F.year("o_orderdate").alias("source_year"), F.month("o_orderdate").alias("source_month"),
        F.col("o_orderkey").alias("source_file_id"),
        F.col("o_orderdate").alias("started_at"),
        F.when(done, F.col("_shipped")).alias("finished_at"),
        F.when(F.col("o_orderstatus") == "F", F.lit("succeeded"))
        .when(~done, F.lit("running")).otherwise("failed").alias("status"),
        F.col("_lines").alias("rows_read"), F.col("_lines").alias("rows_loaded"),
        F.col("_returned").alias("warning_count"),
    )
    return align_columns(rows, PIPELINE_RUNS)


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Chosen columns, clocks without a zone."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return df.select(*[
        F.col(n).cast("timestamp_ntz").alias(n) if kinds[n] == "timestamp" else F.col(n)
        for n in (names or df.columns)
    ])


def register_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = registry.register(
        document_versions(spark, sf_dir), labelled_versions(spark, sf_dir), arrival="doc_id"
    )
    return outcome.select(
        "partition_key", "checksum_sha256", "source_file_id", "status", "decision", "is_new"
    )


def decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_sources(spark, sf_dir).select(
        "source_file_id", "status", registry.decide("status").alias("decision")
    )


def current_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations as ready or revision, loaded only through a succeeded run."""
    registered = order_sources(spark, sf_dir).withColumn(
        "status", F.when(F.col("status") == "revision_detected", F.col("status")).otherwise("ready")
    )
    return plain(
        registry.current_sources(registered, order_runs(spark, sf_dir)),
        "source_file_id", "status", "loaded_at",
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip what may not run, start the rest, finish it; the latest state of every run."""
    sources = order_sources(spark, sf_dir)
    nothing = align_columns(spark.range(0), RUN_EVENTS)
    skipped = runs.log_skipped(sources.where("status <> 'ready'"), nothing, NOW)
    started = runs.start_runs(sources.where("status = 'ready'"), skipped, NOW)
    log = skipped.unionByName(started)
    outcomes = started.join(sources.select("source_file_id", "file_size_bytes"), "source_file_id")
    good = F.col("file_size_bytes") >= 100_000
    outcomes = outcomes.select(
        "run_id", good.alias("succeeded"), F.col("file_size_bytes").alias("rows_read"),
        F.col("file_size_bytes").alias("rows_loaded"),
        F.when(~good, F.lit("too \n  small")).alias("error_message"),
    )
    finished = runs.finish_runs(outcomes, log, sources, NOW)
    return runs.current_runs(log.unionByName(finished)).select(
        "run_id", "source_file_id", "service_type", "status", "status_reason", "rows_read",
        "rows_loaded", "error_message",
    )


def transition_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer id taken as a run that reports success."""
    outcomes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("run_id"), F.lit(True).alias("succeeded"),
        F.lit(None).cast("string").alias("error_message"),
    )
    open_runs = order_runs(spark, sf_dir).where("service_type = 'yellow'")
    return runs.transition_problems(outcomes, open_runs, order_sources(spark, sf_dir))


def current_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log per user; the last event is the state."""
    events = align_columns(table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("status"),
        F.col("ts").alias("started_at"), F.col("event_id").cast("int").alias("event_seq"),
    ), RUN_EVENTS)
    return plain(runs.current_runs(events), "run_id", "status", "started_at")


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose highest line number is not their number of lines."""
    lines = table(spark, sf_dir, "lineitem")
    manifest = lines.groupBy(F.col("l_orderkey").alias("source_file_id")).agg(
        F.max("l_linenumber").cast("bigint").alias("row_count")
    )
    return runs.reconcile_counts(manifest, lines, raw_key="l_orderkey")


def latest_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.latest_success(order_runs(spark, sf_dir), order_sources(spark, sf_dir))


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_version(order_sources(spark, sf_dir))


def active_zone_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as lookup versions whose rows are their order lines."""
    versions = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("source_file_id"), F.lit("taxi_zone_lookup").alias("dataset_name"),
        F.when(F.col("s_acctbal") >= 0, F.lit("loaded")).otherwise("ready").alias("status"),
        F.when(F.col("s_acctbal") >= 1000, F.make_date(F.col("s_nationkey") + 2000, F.lit(1), F.lit(1)))
        .alias("loaded_at"),
    )
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("_source_file_id"))
    return registry.active_zone_source(versions, rows)


def list_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = registry.list_sources(
        order_sources(spark, sf_dir), "yellow", "loaded", year=1997, limit=20, offset=10
    )
    return page.select("source_file_id", "partition_key", "status", "source_month")


def get_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.get_source(order_sources(spark, sf_dir), 7).select(
        "source_file_id", "partition_key", "status"
    )


def list_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = runs.list_runs(order_runs(spark, sf_dir), "green", month=5, limit=25, offset=5)
    return plain(page, "run_id", "started_at", "finished_at", "status", "rows_loaded")


def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(runs.latest_runs(order_runs(spark, sf_dir)), "run_id", "started_at", "status")


def get_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.get_run(order_runs(spark, sf_dir), 7).select("run_id", "status", "rows_loaded")


def run_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violated results of the newest run, with conversations as runs and turns as results."""
    results = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("run_id"), F.col("turn").alias("quality_result_id"),
        F.col("role").alias("check_name"), F.lit("INFO").alias("severity"),
        F.when(F.col("role") == "user", F.lit("violated")).otherwise("passed").alias("status"),
        F.length("text").cast("bigint").alias("rows_checked"),
    )
    return runs.run_quality(results, status="violated")


def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_durations(order_runs(spark, sf_dir))


def pipeline_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.pipeline_kpis(order_sources(spark, sf_dir), order_runs(spark, sf_dir))


def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.loaded_date_bounds(order_sources(spark, sf_dir))


def merge_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order that is not loaded reports a new place: local when ready, archive else."""
    sources = order_sources(spark, sf_dir)
    local = F.col("status") == "ready"
    updates = sources.where("status <> 'loaded'").select(
        "source_file_id", F.when(local, F.lit("local")).otherwise("s3").alias("storage_backend"),
        F.when(~local, F.concat(F.lit("s3://moved/"), "source_file_id")).alias("storage_uri"),
        F.lit(None).cast("string").alias("storage_version_id"),
        F.lit(NOW).cast("timestamp").alias("stored_at"),
    )
    return plain(
        registry.merge_storage(sources, updates),
        "source_file_id", "storage_backend", "storage_uri", "stored_at",
    )


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_sources(spark, sf_dir).select(
        "source_file_id", "partition_key",
        object_key("service_type", "source_year", "source_month", "checksum_sha256")
        .alias("object_key"),
    )


def resolve_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", month_lag("o_orderdate").alias("target_month")
    )


def integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against what their labels registered; benchmark items were never stored."""
    documents = table(spark, sf_dir, "documents")
    observed = documents.select(
        F.col("doc_id").cast("string").alias("partition_key"), F.col("lang").alias("dataset_name"),
        F.sha2("text", 256).alias("checksum_sha256"),
        F.octet_length("text").cast("bigint").alias("file_size_bytes"),
    )
    text = F.when(F.col("quality") == 1, F.col("text")).otherwise(F.lower("text"))
    known = documents.join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("partition_key"), F.col("lang").alias("dataset_name"),
        F.sha2(text, 256).alias("checksum_sha256"),
        F.octet_length("text").cast("bigint").alias("file_size_bytes"),
    )
    lost = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item-"), "item_id").alias("partition_key"),
        F.lit("benchmark").alias("dataset_name"), F.sha2("text", 256).alias("checksum_sha256"),
        F.octet_length("text").cast("bigint").alias("file_size_bytes"),
    )
    return registry.integrity_audit(observed, known.unionByName(lost))


def quality_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer id requested as a run to check."""
    requested = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"))
    known = order_runs(spark, sf_dir).where("service_type = 'yellow'")
    return quality.target_problems(requested, known, order_sources(spark, sf_dir)).select(
        "run_id", "partition_key", "problem"
    )


def t_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared constraints audited on orders as sources and runs, lines as raw rows."""
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("_source_file_id"),
        F.col("l_linenumber").alias("_source_row_number"),
        F.col("l_partkey").alias("_pipeline_run_id"),
        F.col("l_suppkey").alias("LocationID"),
    )
    return checks.constraint_audit(
        order_sources(spark, sf_dir), order_runs(spark, sf_dir), {"lines": raw}, zones="lines"
    )


QUERIES = {
    "register_files": register_files, "decide": decide, "current_sources": current_sources,
    "run_log": run_log, "transition_problems": transition_problems, "current_runs": current_runs,
    "reconcile": reconcile, "latest_success": latest_success, "latest_version": latest_version,
    "active_zone_source": active_zone_source, "list_sources": list_sources,
    "get_source": get_source, "list_runs": list_runs, "latest_runs": latest_runs,
    "get_run": get_run, "run_quality": run_quality, "run_durations": run_durations,
    "pipeline_kpis": pipeline_kpis, "date_bounds": date_bounds, "merge_storage": merge_storage,
    "object_key": object_keys, "resolve_month": resolve_month,
    "integrity_audit": integrity_audit, "quality_targets": quality_targets,
    "t_constraints": t_constraints,
}

SERVICE_SQL = "CASE WHEN o_orderpriority LIKE '1%' THEN 'green' ELSE 'yellow' END"
SOURCES_CTE = f"""sources AS (
  SELECT o_orderkey AS source_file_id, {SERVICE_SQL} AS service_type,
         {SERVICE_SQL} || '_tripdata' AS dataset_name,
         CAST(year(o_orderdate) AS SMALLINT) AS source_year,
         CAST(month(o_orderdate) AS SMALLINT) AS source_month,
         {SERVICE_SQL} || '/' || strftime(o_orderdate, '%Y/%m') AS partition_key,
         sha256(CAST(o_orderkey AS VARCHAR)) AS checksum_sha256,
         CAST(floor(o_totalprice) AS BIGINT) AS file_size_bytes,
         CASE o_orderstatus WHEN 'F' THEN 'loaded' WHEN 'O' THEN 'ready'
              ELSE 'revision_detected' END AS status,
         CASE WHEN o_custkey >= 100 THEN 's3' ELSE 'local' END AS storage_backend,
         CASE WHEN o_custkey >= 100 THEN 's3://archive/' || o_orderkey END AS storage_uri
  FROM orders)"""
RUNS_CTE = f"""runs AS (
  SELECT o_orderkey AS run_id, o_orderkey AS source_file_id, {SERVICE_SQL} AS service_type,
         CAST(year(o_orderdate) AS SMALLINT) AS source_year,
         CAST(month(o_orderdate) AS SMALLINT) AS source_month,
         o_orderdate AS started_at,
         CASE WHEN o_orderstatus <> 'O' THEN shipped END AS finished_at,
         CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'running'
              ELSE 'failed' END AS status,
         lines AS rows_loaded, returned AS warning_count
  FROM orders LEFT JOIN (
    SELECT l_orderkey, count(*) AS lines, max(l_shipdate) AS shipped,
           count(*) FILTER (WHERE l_returnflag = 'R') AS returned
    FROM lineitem GROUP BY 1) AS l ON l_orderkey = o_orderkey)"""
BOTH = f"WITH {SOURCES_CTE}, {RUNS_CTE}"
SECONDS = "greatest(0, date_diff('second', started_at, finished_at))"


def _problem(cases: str, extra: str = "") -> str:
    return f"""{BOTH} SELECT c_custkey AS run_id{extra}, {cases} AS problem FROM customer
      LEFT JOIN (SELECT * FROM runs WHERE service_type = 'yellow') AS r ON r.run_id = c_custkey
      LEFT JOIN sources AS s ON s.source_file_id = r.source_file_id"""


_KEY_COUNT = "(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {t} GROUP BY {c} HAVING count(*) > 1) AS g)"
_CONSTRAINTS = [
    ("source_files", "file_size_positive", "(SELECT count(*) FROM sources WHERE NOT file_size_bytes > 0)"),
    ("source_files", "row_count_nonnegative", "0"),
    ("source_files", "source_month_valid", "(SELECT count(*) FROM sources WHERE NOT source_month BETWEEN 1 AND 12)"),
    ("source_files", "pk_source_files", _KEY_COUNT.format(t="sources", c="source_file_id")),
    ("source_files", "uq_partition_checksum", _KEY_COUNT.format(t="sources", c="partition_key, checksum_sha256")),
    ("pipeline_runs", "rows_read_nonnegative", "(SELECT count(*) FROM runs WHERE NOT rows_loaded >= 0)"),
    ("pipeline_runs", "rows_loaded_nonnegative", "(SELECT count(*) FROM runs WHERE NOT rows_loaded >= 0)"),
    ("pipeline_runs", "warning_count_nonnegative", "(SELECT count(*) FROM runs WHERE NOT warning_count >= 0)"),
    ("pipeline_runs", "error_count_nonnegative", "0"),
    ("pipeline_runs", "source_month_valid", "(SELECT count(*) FROM runs WHERE NOT source_month BETWEEN 1 AND 12)"),
    ("pipeline_runs", "pk_pipeline_runs", _KEY_COUNT.format(t="runs", c="run_id")),
    ("pipeline_runs", "fk_source_file", "(SELECT count(*) FROM runs WHERE source_file_id NOT IN (SELECT source_file_id FROM sources))"),
    ("lines", "source_row_number_positive", "(SELECT count(*) FROM lineitem WHERE NOT l_linenumber > 0)"),
    ("lines", "pk_lines", _KEY_COUNT.format(t="lineitem", c="l_orderkey, l_linenumber")),
    ("lines", "fk_source_file", "(SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))"),
    ("lines", "fk_pipeline_run", "(SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT o_orderkey FROM orders))"),
    ("lines", "uq_source_file_location", _KEY_COUNT.format(t="lineitem", c="l_orderkey, l_suppkey")),
]
ORACLE = {
    "register_files": """
      WITH docs AS (
        SELECT doc_id, source || '/' || lang AS partition_key, sha256(text) AS checksum_sha256
        FROM documents WHERE octet_length(encode(text)) > 0),
      known AS (
        SELECT partition_key, checksum_sha256, min(doc_id) + 1 AS source_file_id,
               CASE WHEN max(quality) = 1 THEN 'loaded' ELSE 'ready' END AS status
        FROM docs JOIN labels USING (doc_id) GROUP BY 1, 2),
      versions AS (SELECT partition_key, checksum_sha256, min(doc_id) AS arrival FROM docs GROUP BY 1, 2),
      fresh AS (
        SELECT v.*, row_number() OVER (ORDER BY arrival) AS n,
               row_number() OVER (PARTITION BY v.partition_key ORDER BY arrival) AS k
        FROM versions v LEFT JOIN known USING (partition_key, checksum_sha256)
        WHERE source_file_id IS NULL),
      outcome AS (
        SELECT partition_key, checksum_sha256, source_file_id, status, false AS is_new
        FROM versions JOIN known USING (partition_key, checksum_sha256)
        UNION ALL
        SELECT partition_key, checksum_sha256, n + (SELECT max(source_file_id) FROM known),
               CASE WHEN k > 1 OR partition_key IN (SELECT partition_key FROM known)
                    THEN 'revision_detected' ELSE 'ready' END, true FROM fresh)
      SELECT *, CASE status WHEN 'ready' THEN 'proceed' WHEN 'loaded' THEN 'already_loaded'
                ELSE 'source_revision_blocked' END AS decision FROM outcome""",
    "decide": f"""WITH {SOURCES_CTE} SELECT source_file_id, status,
      CASE status WHEN 'ready' THEN 'proceed' WHEN 'loaded' THEN 'already_loaded'
           ELSE 'source_revision_blocked' END AS decision FROM sources""",
    "current_sources": f"""{BOTH} SELECT s.source_file_id,
      CASE WHEN s.status = 'revision_detected' THEN s.status
           WHEN r.status = 'succeeded' THEN 'loaded' ELSE 'ready' END AS status,
      CASE WHEN r.status = 'succeeded' THEN r.finished_at END AS loaded_at
      FROM sources s JOIN runs r ON r.run_id = s.source_file_id""",
    "run_log": f"""WITH {SOURCES_CTE} SELECT
      CASE WHEN status <> 'ready' THEN row_number() OVER (PARTITION BY status = 'ready' ORDER BY source_file_id)
           ELSE row_number() OVER (PARTITION BY status = 'ready' ORDER BY source_file_id)
                + (SELECT count(*) FROM sources WHERE status <> 'ready') END AS run_id,
      source_file_id, service_type,
      CASE WHEN status <> 'ready' THEN 'skipped' WHEN file_size_bytes >= 100000 THEN 'succeeded'
           ELSE 'failed' END AS status,
      CASE status WHEN 'loaded' THEN 'already_loaded'
           WHEN 'revision_detected' THEN 'source_revision_detected' END AS status_reason,
      CASE WHEN status = 'ready' AND file_size_bytes >= 100000 THEN file_size_bytes END AS rows_read,
      CASE WHEN status <> 'ready' THEN 0 WHEN file_size_bytes >= 100000 THEN file_size_bytes END AS rows_loaded,
      CASE WHEN status = 'ready' AND file_size_bytes < 100000
           THEN 'Raw ingestion failed: too small' END AS error_message FROM sources""",
    "transition_problems": f"""SELECT * FROM ({_problem('''CASE
      WHEN r.status IS NULL THEN 'Unknown run ID: ' || c_custkey
      WHEN r.status <> 'running' THEN 'Run ' || c_custkey || ' is terminal with status ' || r.status
      WHEN s.status <> 'ready' THEN 'Cannot mark source ' || c_custkey || ' loaded from status ' || s.status
      END''')}) AS p WHERE problem IS NOT NULL""",
    "current_runs": """SELECT user_id AS run_id, arg_max(event_type, event_id) AS status,
      arg_max(ts, event_id) AS started_at FROM events GROUP BY 1""",
    "reconcile": """SELECT * FROM (SELECT l_orderkey AS source_file_id,
      CAST(max(l_linenumber) AS BIGINT) AS rows_expected, count(*) AS rows_loaded
      FROM lineitem GROUP BY 1) AS r WHERE rows_expected <> rows_loaded""",
    "latest_success": f"""{BOTH} SELECT r.service_type, r.source_year, r.source_month, max(run_id) AS run_id
      FROM runs r JOIN sources s ON s.source_file_id = r.source_file_id AND s.status = 'loaded'
      WHERE r.status = 'succeeded' GROUP BY 1, 2, 3""",
    "latest_version": f"WITH {SOURCES_CTE} SELECT partition_key, max(source_file_id) AS source_file_id FROM sources GROUP BY 1",
    "active_zone_source": """SELECT source_file_id, count(*) AS zone_count FROM (
      SELECT s_suppkey AS source_file_id FROM supplier WHERE s_acctbal >= 0
      ORDER BY CASE WHEN s_acctbal >= 1000 THEN s_nationkey END DESC NULLS LAST, s_suppkey DESC
      LIMIT 1) AS top JOIN lineitem ON l_suppkey = source_file_id GROUP BY 1""",
    "list_sources": f"""WITH {SOURCES_CTE} SELECT source_file_id, partition_key, status, source_month
      FROM sources WHERE service_type = 'yellow' AND status = 'loaded' AND source_year = 1997
      ORDER BY source_file_id DESC LIMIT 20 OFFSET 10""",
    "get_source": f"WITH {SOURCES_CTE} SELECT source_file_id, partition_key, status FROM sources WHERE source_file_id = 7",
    "list_runs": f"""{BOTH} SELECT run_id, started_at, finished_at, status, rows_loaded FROM runs
      WHERE service_type = 'green' AND source_month = 5
      ORDER BY started_at DESC, run_id DESC LIMIT 25 OFFSET 5""",
    "latest_runs": f"{BOTH} SELECT run_id, started_at, status FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 50",
    "get_run": f"{BOTH} SELECT run_id, status, rows_loaded FROM runs WHERE run_id = 7",
    "run_quality": """SELECT conv_id AS run_id, turn AS quality_result_id, role AS check_name,
      'INFO' AS severity, 'violated' AS status, CAST(length(text) AS BIGINT) AS rows_checked
      FROM conversations WHERE conv_id = (SELECT max(conv_id) FROM conversations) AND role = 'user'""",
    "run_durations": f"""{BOTH} SELECT run_id, status, CASE WHEN finished_at IS NULL THEN 0 ELSE {SECONDS} END AS duration_seconds,
      CASE WHEN finished_at IS NULL THEN 'In progress'
        WHEN {SECONDS} >= 3600 THEN ({SECONDS} // 3600) || 'h ' || ({SECONDS} % 3600 // 60) || 'm ' || ({SECONDS} % 60) || 's'
        WHEN {SECONDS} >= 60 THEN ({SECONDS} // 60) || 'm ' || ({SECONDS} % 60) || 's'
        ELSE {SECONDS} || 's' END AS duration_label FROM runs""",
    "pipeline_kpis": f"""{BOTH} SELECT
      (SELECT count(*) FROM sources WHERE status = 'loaded') AS loaded_source_files,
      (SELECT count(*) FROM runs WHERE status = 'succeeded') AS successful_runs,
      (SELECT CAST(coalesce(sum(warning_count), 0) AS BIGINT) FROM runs) AS quality_warnings""",
    "date_bounds": f"""WITH {SOURCES_CTE} SELECT CAST(min(m) AS DATE) AS first_day, last_day(max(m)) AS last_day
      FROM (SELECT make_date(source_year, source_month, 1) AS m FROM sources WHERE status = 'loaded') AS b""",
    "merge_storage": f"""WITH {SOURCES_CTE}, n AS (SELECT *,
        status = 'loaded' OR (status = 'ready' AND storage_backend = 's3') AS keep FROM sources)
      SELECT source_file_id,
        CASE WHEN keep THEN storage_backend WHEN status = 'ready' THEN 'local' ELSE 's3' END AS storage_backend,
        CASE WHEN keep THEN storage_uri WHEN status <> 'ready' THEN 's3://moved/' || source_file_id END AS storage_uri,
        CASE WHEN NOT keep THEN TIMESTAMP '2025-03-01 00:00:00' END AS stored_at FROM n""",
    "object_key": f"""WITH {SOURCES_CTE} SELECT source_file_id, partition_key,
      'landing/' || partition_key || '/' || checksum_sha256 || '.parquet' AS object_key FROM sources""",
    "resolve_month": """SELECT o_orderkey,
      CAST(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH AS DATE) AS target_month FROM orders""",
    "integrity_audit": """
      WITH o AS (SELECT CAST(doc_id AS VARCHAR) AS partition_key, sha256(text) AS c FROM documents),
      r AS (SELECT CAST(doc_id AS VARCHAR) AS partition_key,
              sha256(CASE WHEN quality = 1 THEN text ELSE lower(text) END) AS c
            FROM documents JOIN labels USING (doc_id)
            UNION ALL SELECT 'item-' || item_id, sha256(text) FROM benchmark)
      SELECT coalesce(o.partition_key, r.partition_key) AS partition_key,
        CASE WHEN o.c IS NULL THEN 'missing' WHEN r.c IS NULL THEN 'unregistered'
             WHEN o.c <> r.c THEN 'conflict' ELSE 'ok' END AS verdict,
        r.c AS registered_checksum, o.c AS observed_checksum
      FROM o FULL OUTER JOIN r ON o.partition_key = r.partition_key""",
    "quality_targets": _problem("""CASE
      WHEN r.status IS NULL THEN 'Unknown pipeline run ID: ' || c_custkey
      WHEN r.status <> 'succeeded' THEN 'Run ' || c_custkey || ' has status ' || r.status || '; quality requires succeeded'
      WHEN s.status <> 'loaded' THEN 'Run ' || c_custkey || ' does not reference a loaded source'
      END""", ", s.partition_key"),
    "t_constraints": f"{BOTH} " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS constraint_name, CAST({v} AS BIGINT) AS violations"
        for t, n, v in _CONSTRAINTS
    ),
}
