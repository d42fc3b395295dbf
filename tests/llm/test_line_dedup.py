import hashlib
import re
from collections import Counter

from fareledger.llm import line_dedup
from fareledger.llm.common import table
from fareledger.llm.line_dedup import LineRuns, batch_counts, key_hash, without_frequent_lines
from pyspark.sql import functions as F
from tests.llm.cases import awkward, frame

SF_DIR = "/root/testdata/sf0.001"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_docs, min_chars=1):
    found = Counter(key for _, text in rows for key in {key_of(x) for x in (text or "").split("\n")})
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < min_chars or found[key_of(x)] < min_docs]
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((str(doc_id), len(lines), len(lines) - len(kept), sha))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def test_equals_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(line_dedup.line_dedup(docs)) == brute(rows, 10)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(line_dedup.line_dedup(docs, min_docs=2)) == brute(rows, 2)
    cut = without_frequent_lines(docs, min_docs=2)
    assert cut.dtypes == docs.dtypes
    texts = {r.doc_id: r.text for r in cut.collect() if r.doc_id in (1, 4, 10)}
    assert texts == {1: None, 4: "", 10: ""}
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_a_text_of_many_dropped_lines(spark):
    text = "\n".join(f"line {i}" if i % 3 else f"own {i}" for i in range(5000))
    rows = [(1, text), (2, text.replace("own", "other"))]
    assert got(line_dedup.line_dedup(frame(spark, rows), min_docs=2)) == brute(rows, 2)


def test_runs_settle_and_find_keys_over_batches(spark):
    runs = LineRuns(spark, min_docs=3, fanout=2)

    def batch(*docs):
        keys = spark.createDataFrame([(list(d),) for d in docs], "keys array<string>")
        return batch_counts(keys.select(F.transform("keys", key_hash).alias("hashes")))
    runs.add(batch(["a", "b"], ["a"]))
    assert runs.unseen(batch(["a", "new"])).count() == 1
    runs.add(batch(["a", "c"]))          # merged: a settles
    assert [len(level) for level in runs.levels] == [0, 1] and len(runs.closed) == 1
    assert runs.unsettled(batch(["a", "d"])).count() == 1
    runs.add(batch(["b"], ["b", "d"]))
    frequent = {tuple(r) for r in runs.frequent().collect()}
    expect = spark.createDataFrame([("a",), ("b",)], "k string").select(key_hash(F.col("k")).alias("h")).select("h.*")
    assert frequent == {tuple(r) for r in expect.collect()}


def test_main_path_is_native(spark):
    plan = line_dedup.line_dedup(table(spark, SF_DIR, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
