import random
from collections import defaultdict

import pytest

from fareledger.llm import packing
from fareledger.llm.common import table
from tests.llm.cases import awkward


def plain_best_fit(items, capacity):
    """[(need, source, cluster)] from the longest on: bin of each, by looking at every bin."""
    bins, placed = [], {}
    for row in sorted(range(len(items)), key=lambda i: -items[i][0]):
        need, source, cluster = items[row]
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= need
                and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        bins[at]["room"] -= need
        bins[at]["sources"].add(source)
        bins[at]["clusters"].add(cluster)
        placed[row] = at
    return placed


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_best_fit(seed, monkeypatch):
    import numpy as np
    monkeypatch.setattr(packing, "SCAN", 4)
    rng = random.Random(seed)
    items = [(rng.randint(1, 100), rng.choice([None, *range(70)]) if rng.random() < 0.6 else 0,
              rng.choice([None, *range(90)])) for _ in range(900)]
    number = lambda k: np.array([-1 if x[k] is None else x[k] for x in items])
    found = packing.pack_shard(None, np.array([x[0] for x in items]), number(1), number(2), 70, 90, 100)
    assert {row: at for at, row, *_ in found} == plain_best_fit(items, 100)


def check(rows, docs, capacity):
    """Every token of every document once; no bin too full; no source or cluster twice in a bin."""
    length = defaultdict(list)
    for r in docs.collect():
        length[r.doc_id].append((len((r.text or "").split()) + 1, r.source, r.text))
    spans, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start_word, r.n_tokens))
        bins[r.bin_id].append(r)
    for doc_id, own in length.items():
        assert sum(n for _, n in spans[doc_id]) == sum(n for n, _, _ in own)
    for own in bins.values():
        assert sum(r.n_tokens for r in own) == own[0].bin_tokens <= capacity
        assert sorted(r.place for r in own) == list(range(len(own)))
        if all(len(length[r.doc_id]) == 1 for r in own):
            known = [length[r.doc_id][0] for r in own]
            sources = [s for _, s, _ in known if s is not None]
            texts = [t for _, _, t in known if t]
            assert len(set(sources)) == len(sources) and len(set(texts)) == len(texts)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    check(packing.pack(docs, shard_rows=300).collect(), docs, packing.CAPACITY)


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(packing.pack(docs, capacity=100).collect(), docs, 100)
    assert packing.pack(docs.limit(0)).count() == 0
