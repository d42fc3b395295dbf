import random
import re
from collections.abc import Iterator

import pyarrow as pa

from fareledger.llm.common import table
from fareledger.llm.components import components
from fareledger.llm.near_dups import (
    forest, jaccard_classes, least_similarity, one_of_each, prefix_depth, recall_at)
from tests.llm.cases import awkward, frame

SF_DIR = "/root/testdata/sf0.001"


def runs_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """{position: (links, class)} by comparing every pair of texts."""
    sets = [runs_of(text) for _, text in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return sorted((str(rows[i][0]), links[i], str(least[root(i)])) for i in range(len(rows)))


def got(df):
    return sorted((str(r.doc_id), r.n_links, str(r.class_id)) for r in df.collect())


def test_equals_brute_force_on_the_table(spark):
    docs = table(spark, SF_DIR, "documents")
    assert got(jaccard_classes(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_large_groups_are_dealt_in_blocks(spark, monkeypatch):
    from fareledger.llm import near_dups
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    rng = random.Random(1)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(120)] = f"x{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, f"alone {i} " + " ".join(f"q{i}_{k}" for k in range(30))) for i in range(10)]
    assert got(jaccard_classes(frame(spark, rows))) == brute(rows)


def test_a_task_holds_a_bounded_number_of_sets(spark, monkeypatch):
    from fareledger.llm import near_dups
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    plain = near_dups.verifier

    def bounded(threshold):
        verify = plain(threshold)

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = list(batches)
            assert sum(b.num_rows for b in held) <= 60
            return verify(iter(held))
        return check
    monkeypatch.setattr(near_dups, "verifier", bounded)
    rng = random.Random(3)
    rows = []
    for i in range(160):
        words = [f"w{k}" for k in range(120)]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(120)] = f"x{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    assert got(jaccard_classes(frame(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(jaccard_classes(docs)) == brute(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert one_of_each(docs.limit(0)).count() == 0
    assert {r.text for r in kept.collect()} >= {None, ""}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert sorted(map(tuple, components(edges).collect())) == [(i, 0) for i in range(41)] + [(100, 100), (101, 100)]


def test_prefixes_are_shortened_to_the_target_recall():
    depths = [prefix_depth(n) for n in range(1, 400)]
    assert depths[:3] == [None] * 3 and min(depths[3:]) == depths[-1] == 5 and max(depths[3:]) > 5
    for n, depth in enumerate(depths[3:], start=4):
        assert recall_at(depth, 24, least_similarity(n)) >= 0.9999


def test_least_similarity_of_small_sets():
    for n in range(1, 30):
        found = [k / (n + m - k) for m in range(1, 60) for k in range(1, min(n, m) + 1)
                 if k < max(n, m) and k / (n + m - k) >= 0.8 - 1e-12]
        assert least_similarity(n) == (min(found) if found else None)


def plain_meets(rows):
    """Pairs whose common prefix is as long as the longer of their two."""
    out = set()
    for i, (tree, label, a, da) in enumerate(rows):
        for other, text, b, db in rows[:i]:
            need = 2 * max(da, db)
            if tree == other and label[:need] == text[:need] and a != b:
                out.add(frozenset((a, b)))
    return out


def roots(pairs, nodes):
    root = {x: x for pair in pairs for x in pair} | {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {}
    for x in nodes:
        groups.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def test_the_forest_meets_whom_common_prefixes_say_however_it_is_cut():
    rng = random.Random(5)
    nodes = {i: rng.randrange(5, 9) for i in range(120)}
    rows = []
    for i, depth in nodes.items():
        for tree in range(2):
            label = b"".join(bytes([0, rng.randrange(2) if k < 6 else rng.randrange(3)]) for k in range(8))
            rows.append((tree, label, i, depth))
    rows.sort()
    expected = roots([tuple(p) for p in plain_meets(rows)], nodes)
    for parts, size in ((1, 500), (1, 7), (5, 4), (60, 3)):
        cuts = sorted(rng.sample(range(1, len(rows)), parts - 1))
        pairs = []
        for low, high in zip([0, *cuts], [*cuts, len(rows)]):
            table_ = pa.Table.from_pylist([dict(zip(("tree", "label", "node", "depth"), r)) for r in rows[low:high]])
            for batch in forest(iter(table_.to_batches(max_chunksize=size))):
                pairs += zip(*(batch.column(c).to_pylist() for c in ("a", "b")))
        assert roots(pairs, nodes) == expected


def test_recall_of_pairs_just_over_the_threshold(spark):
    """Pairs between 0.8 and 0.85, all of different texts: none is lost."""
    rng = random.Random(8)
    rows = []
    for i in range(150):
        words = [f"w{i}_{k}" for k in range(204)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:rng.randrange(165, 173)], "x"]))]
    sets = [runs_of(text) for _, text in rows]
    near = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert all(0.78 < x < 0.86 for x in near)
    links = {r.doc_id: r.n_links for r in jaccard_classes(frame(spark, rows)).collect()}
    assert [links[2 * i] for i in range(150)] == [int(x >= 0.8) for x in near]
