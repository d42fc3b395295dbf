import random
import re

import numpy as np
import pyspark.sql.functions as F
import pytest
import xxhash

from fareledger.llm import simhash as S
from fareledger.llm.common import table
from fareledger.llm.queries import QUERIES
from tests.llm.cases import awkward, frame

SF_DIR = "/root/testdata/sf0.001"


def plain_print(text):
    """The contract's fingerprint, bit by bit."""
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    runs = [words[i:i + 4] for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=4):
    """{(doc_id, fingerprint): component} by comparing every two fingerprints."""
    prints = [plain_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(d), f"{prints[i]:016x}", str(least.get(root(i)))) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_whole_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    assert got(QUERIES["op13_simhash"](spark, SF_DIR)) == plain_components(rows)


def test_spark_hash_is_the_same_hash(spark):
    words = ["one two three four", "Ünïcode 漢字 text here", ""]
    native = [r[0] & (2**64 - 1) for r in
              spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
    assert native == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert got(S.simhash_components(docs)) == plain_components([(r.doc_id, r.text) for r in docs.collect()])
    empty = S.simhash_components(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "fingerprint", "component_id", "n_same"]


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_position_sets_cover_every_guaranteed_match(width):
    from itertools import combinations
    family = S.position_sets(width, 4)
    assert all(any(set(f) <= set(s) for f in family) for s in combinations(range(8), 4))
    assert len(family) <= {1: 5, 2: 8, 3: 23, 4: 70}[width]  # 7 and 20 are the least for 2 and 3


def cloud(seed, n, centres, flips):
    rng = random.Random(seed)
    heart = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    for _ in range(n):
        fp = rng.choice(heart)
        for _ in range(rng.randint(0, flips)):
            fp ^= 1 << rng.randrange(64)
        out.add(fp)
    return sorted(out)


def plain_roots(prints, distance=4):
    root = list(range(len(prints)))
    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance):
            a, b = root[i], root[j]
            if a != b:
                root = [min(a, b) if r in (a, b) else r for r in root]
    return {p: prints[r] for p, r in zip(prints, root)}


@pytest.mark.parametrize("width, block", [(2, 4096), (2, 40), (3, 40), (4, 16)])
def test_links_at_every_width_and_in_blocks(spark, width, block):
    """Dense and sparse clouds: the components are those of all pairs, however lists are dealt."""
    prints = cloud(5, 500, 6, 9)
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    edges = S.links(spark.createDataFrame(signed, "fp long"), width=width, block=block).collect()
    mask = 2**64 - 1
    assert all(((e.a ^ e.b) & mask).bit_count() <= 4 for e in edges)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for e in edges:
        a, b = sorted((root(e.a & mask), root(e.b & mask)))
        parent[b] = a
    want = plain_roots(prints)
    assert len(set(want.values())) > 3 and max(map(list(want.values()).count, want.values())) > 20
    assert {p: root(p) for p in prints} == want


def test_a_list_longer_than_a_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        prints = cloud(8, 120, 1, 3)
        signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
        edges = S.links(spark.createDataFrame(signed, "fp long")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    assert len({e.a for e in edges} | {e.b for e in edges}) == len(prints)


def test_width_grows_with_the_table_only():
    assert [S.key_width(n, 4) for n in (10, 10**6, 10**8, 10**11)] == [2, 2, 3, 4]


def test_repeats_and_near_copies_join(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base), (3, base), (9, base + " tail"), (4, "quite another text with words of its own")]
    found = {r.doc_id: r.component_id for r in S.simhash_components(frame(spark, rows)).collect()}
    assert found == {5: 3, 3: 3, 9: 3, 4: 4}
