"""Quality rules with a hashed n-gram log-likelihood ratio; DataFrame operations only.

Two multinomials over hashed words and word pairs are counted over the whole corpus: one of all
documents, one of the trusted ones. A document's score is the mean, over its n-grams, of the log
ratio of the trusted to the raw probability; one fixed threshold decides on every document.

Defined results: null and empty texts have no words, fail the base rule and score 0; repeated ids
are judged row by row; without trusted documents both multinomials are flat and every score stays
near the raw corpus's own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.llm.common import once, stored, text_of
from fareledger.llm.line_dedup import BLANK, lines_of

BUCKETS = 1 << 14
MARKS = 1 << 20  # bits of the table that tells documents which may be trusted
#: Mean log ratio below which a document is unlike the trusted ones.
THRESHOLD = -0.05
MIN_WORDS, MAX_REPEAT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
SPLIT = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT))


def hashed_grams(hashes: str, buckets: int) -> Column:
    """Buckets of the words and word pairs of an array of word hashes."""
    return F.expr(
        f"concat(transform({hashes}, h -> pmod(h, {buckets}L)),"
        f" if(size({hashes}) < 2, array(), transform(sequence(0, size({hashes}) - 2),"
        f" i -> pmod(xxhash64({hashes}[i], {hashes}[i + 1]), {buckets}L))))")


def word_hashes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_hashes``, one hash for each word of the text."""
    return docs.withColumn("_words", words_of(text_of())).withColumn(
        "_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def marks(ids: DataFrame) -> Column:
    """Whether ``doc_id`` may be one of ``ids``: one bit of a fixed table for each hash of an id.

    The table has the same size for any number of ids; a false hit is settled by the join after it.
    """
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    words = ids.groupBy(F.shiftright(mark, 6).alias("word")).agg(F.bit_or(F.expr(
        f"shiftleft(1L, cast(pmod(pmod(xxhash64(doc_id), {MARKS}L), 64L) as int))")).alias("bits")).collect()
    table = [0] * (MARKS // 64)
    for word, bits in words:
        table[word] = bits
    held = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    word = F.get(held, F.shiftright(mark, 6).cast("int"))
    return F.coalesce(F.getbit(word, F.pmod(mark, F.lit(64)).cast("int")) == 1, F.lit(False))


def count_buckets(grams: DataFrame, buckets: int) -> list[int]:
    """Count of each bucket plus one; at most one row a bucket and task is shuffled."""
    out = [1] * buckets
    for bucket, n in grams.select(F.explode("_grams").alias("bucket")).groupBy("bucket").count().collect():
        out[bucket] += n
    return out


def fit_ratio(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Log ratio of each bucket; ``trusted`` holds the doc_id of every trusted document.

    All n-grams of all documents are counted where they are read, without a join. For the target,
    documents that may be trusted are told by a table of fixed size before their words are hashed;
    what passes is merged with the ids, two bytes an n-gram, by the same join at every size.
    """
    kind = "array<smallint>" if buckets <= 1 << 15 else "array<int>"

    def grams(rows: DataFrame, *columns: str) -> DataFrame:
        # Each array is worked out where it stands; a filter on its size would repeat it for each word.
        hashed = word_hashes(rows).select(*columns, once(F.col("_hashes")).alias("_hashes"))
        return hashed.select(*columns, once(hashed_grams("_hashes", buckets).cast(kind)).alias("_grams"))
    ids = stored(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    raw = count_buckets(grams(texts), buckets)
    likely = grams(texts.where(marks(ids)), "doc_id")
    target = count_buckets(likely.join(ids.hint("merge"), "doc_id", "left_semi"), buckets)
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw)]


def literal_array(values: list[float]) -> Column:
    """A constant array folded once into the plan."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


#: Starts of windows that occur twice or more in a text, in order; windows are compared by hash.
REPEATED = """
sort_array(transform(
  filter(transform(sequence(0, size(_sorted) - 1), i -> named_struct('at', _sorted[i].at, 'twice',
      (i > 0 and _sorted[i].h = _sorted[i - 1].h) or
      (i < size(_sorted) - 1 and _sorted[i].h = _sorted[i + 1].h))), x -> x.twice),
  x -> x.at))"""


def base_counts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the counts of the base rule; needs ``_words`` and ``_hashes``."""
    text = text_of()
    whole = F.filter(lines_of(text), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    windows = F.expr(
        f"if(size(_hashes) < {window}, array(), transform(sequence(0, size(_hashes) - {window}),"
        f" i -> xxhash64({', '.join(f'_hashes[i + {k}]' for k in range(window))})))")
    some = F.size("_windows") > F.size(F.array_distinct("_windows"))
    return (
        docs.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(text, SPLIT, "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn("_whole", whole)
        .withColumn("n_dup_lines", (F.size("_whole") - F.size(F.array_distinct("_whole"))).cast("long"))
        .withColumn("_windows", windows)
        # Few texts repeat a window; only those sort theirs.
        .withColumn("_sorted", F.when(some, F.expr(
            "array_sort(transform(_windows, (h, i) -> named_struct('h', h, 'at', i)))")))
        .withColumn("_repeated", F.when(F.col("_sorted").isNotNull(), F.expr(REPEATED)))
        .withColumn("n_repeat_words", F.when(F.col("_repeated").isNull(), F.lit(0)).otherwise(F.expr(
            f"aggregate(sequence(0, size(_repeated) - 1), 0, (n, i) -> n + if(i = size(_repeated) - 1,"
            f" {window}, least({window}, _repeated[i + 1] - _repeated[i])))")).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
    )


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD,
                  buckets: int = BUCKETS) -> DataFrame:
    """One row per document: base counts, ``score`` (mean log ratio) and ``kept``."""
    ratio = literal_array(fit_ratio(docs, trusted, buckets))
    scored = (base_counts(word_hashes(docs.select("doc_id", "text")))
              .withColumn("_grams", hashed_grams("_hashes", buckets))
              .withColumn("score", F.when(F.size("_grams") == 0, F.lit(0.0)).otherwise(
                  F.aggregate("_grams", F.lit(0.0), lambda s, g: s + ratio[g.cast("int")]) / F.size("_grams"))))
    scored = scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    return scored.select(*[once(F.col(c)).alias(c) for c in (
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "score")])
