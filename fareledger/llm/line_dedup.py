"""Line dedup by levelled sorted runs of line hashes; DataFrame operations only.

Every delivered batch of documents becomes one sorted run of (key hash, documents). Runs are
levelled: as soon as a level holds ``fanout`` runs they are merged into one run of the next level.
A merge moves keys that have reached ``min_docs`` into a closed run; later batches merge-anti-join
the closed runs, so a settled line costs one probe and is never counted or rewritten again.

Defined results: a null or empty text is one empty line; each row is a document of its own, also
with a repeated or null id; an empty table gives empty results; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareledger.llm.common import once, row_key, stored, text_of

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """A line without blanks at both ends and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def key_hash(key: Column) -> Column:
    """128 bits of a key as two words of different hashes."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("run"), key).alias("h2"))


def long_keys(lines: Column, min_chars: int) -> Column:
    """The distinct keys of a document's lines that have at least ``min_chars`` code points."""
    keys = F.array_distinct(F.transform(lines, line_key))
    return F.filter(keys, lambda k: F.length(k) >= min_chars)


def batch_counts(keys: DataFrame) -> DataFrame:
    """(h1, h2, n_docs) of a batch from its documents' arrays ``hashes`` of distinct keys."""
    return (keys.select(F.inline("hashes")).groupBy(*KEY)
            .agg(F.count(F.lit(1)).alias("n_docs")))


class LineRuns:
    """Levelled sorted runs of line hashes with their document counts."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 2) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.closed: list[DataFrame] = []

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """A batch's keys that no closed run holds."""
        for run in self.closed:
            counts = counts.join(run, KEY, "left_anti")
        return counts

    def unseen(self, counts: DataFrame) -> DataFrame:
        """A batch's keys that no earlier batch held, for keeping first occurrences only."""
        for run in [*self.closed, *(run for level in self.levels for run in level)]:
            counts = counts.join(run, KEY, "left_anti")
        return counts

    def add(self, counts: DataFrame) -> None:
        """Merge-anti-join a batch with the runs, then add its own run and compact."""
        run = stored(self.unsettled(counts).select(*KEY, "n_docs").sortWithinPartitions(*KEY))
        self._put(run, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self._merge(self.levels[level])
            self.levels[level] = []
            self.closed.append(stored(self._frequent(merged)))
            self._put(stored(merged.where(F.col("n_docs") < self.min_docs)), level + 1)

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return stored(rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs")).sortWithinPartitions(*KEY))

    def _frequent(self, merged: DataFrame) -> DataFrame:
        return merged.where(F.col("n_docs") >= self.min_docs)

    def frequent(self) -> DataFrame:
        """(h1, h2) of every key found in at least ``min_docs`` documents of all batches."""
        open_runs = [run for level in self.levels for run in level]
        parts = [run.select(*KEY) for run in self.closed]
        if open_runs:
            parts.append(stored(self._frequent(self._merge(open_runs)).select(*KEY)))
        if not parts:
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint")
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows


def count_runs(docs: DataFrame, min_docs: int, min_chars: int, batches: int) -> LineRuns:
    """Runs of all lines of ``docs``, delivered in ``batches`` parts by row key."""
    hashes = F.transform(long_keys(lines_of(text_of()), min_chars), key_hash)
    keys = row_key()
    spark, path = docs.sparkSession, docs.select(
        F.pmod(keys, F.lit(batches)).alias("batch"), hashes.alias("hashes"))
    table = stored(path.where(F.size("hashes") > 0))
    runs = LineRuns(spark, min_docs)
    for batch in range(batches):
        runs.add(batch_counts(table.where(F.col("batch") == batch)))
    return runs


def cut_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4) -> DataFrame:
    """One row (doc, n_lines, n_dropped, kept_text) per document; ``doc`` holds its own columns.

    Every line whose key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents goes, in all documents; the other lines stay, joined by a line feed.
    """
    frequent = count_runs(docs, min_docs, min_chars, batches).frequent()
    lines = (docs.select(row_key().alias("row"), F.posexplode(lines_of(text_of())).alias("at", "line"))
             .select("row", "at", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= min_chars)
             .select("row", "at", key_hash(F.col("key")).alias("h"))
             .select("row", "at", "h.*"))
    dropped = (lines.join(frequent, KEY, "left_semi")
               .groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("gone")))
    # Kept lines are the stretches between dropped ones, so a text of many lines is cut in one walk.
    stretches = F.expr(
        "transform(sequence(0, size(gone)), i -> slice(lines, if(i = 0, 1, gone[i - 1] + 2),"
        " if(i = size(gone), size(lines), gone[i]) - if(i = 0, 0, gone[i - 1] + 1)))")
    return (docs.select(row_key().alias("row"), text_of().alias("text"), F.struct("*").alias("doc"))
            .join(dropped, "row", "left").withColumn("lines", once(lines_of(F.col("text"))))
            .select("doc", F.size("lines").cast("long").alias("n_lines"),
                    F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
                    F.when(F.col("gone").isNull(), F.col("text"))
                    .otherwise(F.array_join(F.flatten(stretches), "\n")).alias("kept_text")))


def without_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the frequent lines cut from ``text``; ``n_chars`` follows where it is a column.

    A document left without a line keeps an empty text.
    """
    cut = cut_lines(docs, min_docs, min_chars)
    fresh = {"text": F.when(F.col("doc.text").isNull(), F.lit(None)).otherwise(F.col("kept_text")),
             "n_chars": F.when(F.col("n_dropped") == 0, F.col("doc.n_chars") if "n_chars" in docs.columns else F.lit(0))
             .otherwise(F.length("kept_text"))}
    return cut.select([(fresh[f.name].cast(f.dataType) if f.name in fresh else F.col("doc")[f.name]).alias(f.name)
                       for f in docs.schema])


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """One row per document: line counts and the SHA-256 of what stays of its text."""
    return cut_lines(docs.select("doc_id", "text"), min_docs, min_chars).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS line FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id"""
