import math
import re
from collections import Counter

import xxhash

from fareledger.llm import quality_rules
from fareledger.llm.common import table
from tests.llm.cases import awkward

SF_DIR = "/root/testdata/sf0.001"
BUCKETS = quality_rules.BUCKETS


def hashed(data, seed=42):
    return xxhash.xxh64(data, seed=seed).intdigest()


def grams(text):
    hashes = [hashed(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    pairs = [hashed(b.to_bytes(8, "little"), hashed(a.to_bytes(8, "little"))) for a, b in zip(hashes, hashes[1:])]
    signed = [h - (1 << 64) if h >> 63 else h for h in hashes + pairs]
    return [h % BUCKETS for h in signed]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def check(docs, trusted):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ids = {r.doc_id for r in trusted.collect()}
    raw, target = Counter(), Counter()
    for doc_id, text in rows:
        raw.update(grams(text))
        if doc_id in ids:
            target.update(grams(text))
    n_raw, n_target = (sum(c.values()) + BUCKETS for c in (raw, target))

    def score(text):
        own = grams(text)
        logs = [math.log((target[g] + 1) / n_target) - math.log((raw[g] + 1) / n_raw) for g in own]
        return sum(logs) / len(own) if own else 0.0
    expect = sorted((str(i), *base(t), round(score(t), 9), not base(t)[-1] and score(t) >= quality_rules.THRESHOLD)
                    for i, t in rows)
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                  round(r.score, 9), r.kept) for r in quality_rules.quality_rules(docs, trusted).collect())
    assert got == expect


def test_equals_brute_force(spark):
    check(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels").where("quality = 1"))


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(docs, docs.where("doc_id in (7, 10)").select("doc_id"))
    check(docs, docs.where("false").select("doc_id"))
    assert quality_rules.quality_rules(docs.limit(0), docs.select("doc_id")).count() == 0


def test_labels_of_low_quality_are_rejected(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    found = quality_rules.quality_rules(docs, labels.where("quality = 1")).join(labels, "doc_id").where("n_words >= 20")
    share = {r.quality: (r["count"], r.kept) for r in found.groupBy("quality").agg(
        {"*": "count", "kept": "count_if"}).withColumnsRenamed({"count(1)": "count", "count_if(kept)": "kept"}).collect()}
    assert share[1][1] >= 0.98 * share[1][0] and share[0][1] <= 0.2 * share[0][0]
    assert found.where("kept").count() == sum(kept for _, kept in share.values())


def test_main_path_is_native(spark):
    docs, labels = (table(spark, SF_DIR, t) for t in ("documents", "labels"))
    plan = quality_rules.quality_rules(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_trusted_document_counts(spark):
    docs = spark.range(10_400).selectExpr("id as doc_id", "concat_ws(' ', 'w' || id % 7, 'only' || id) as text")
    check(docs, docs.where("doc_id % 50 > 0 or doc_id < 10300").select("doc_id"))


def test_ids_meet_documents_by_one_plan_at_every_size(spark):
    """No broadcast of ids, and the table of marks lets every trusted document through."""
    ids = spark.range(0, 3000, 3).selectExpr("id * 7919 - 5000 as doc_id")
    docs = spark.range(3000).selectExpr("id * 7919 - 5000 as doc_id")
    mark = quality_rules.marks(ids)
    passed = docs.where(mark)
    assert passed.join(ids, "doc_id").count() == 1000 and passed.count() < 1100
    assert docs.where(quality_rules.marks(ids.limit(0))).count() == 0
