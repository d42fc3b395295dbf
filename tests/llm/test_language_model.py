import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fareledger.llm import language_model as lm
from fareledger.llm import words as W
from fareledger.llm.common import table
from tests.llm.cases import awkward

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows, order):
    """States, arcs and failure arcs in dictionaries, one walk over each whole text."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    texts = [tokens(t) for _, t in rows]
    counts = Counter()
    for text, out in zip(texts, held):
        if not out:
            counts.update(tuple(text[k - n:k]) for n in range(1, order + 1) for k in range(n, len(text) + 1))
    after = Counter(g[:-1] for g in counts)
    sizes = [Counter(c for g, c in counts.items() if len(g) == n) for n in range(order + 1)]
    discount = [(s[1] + 1) / (s[1] + 2 * s[2] + 2) for s in sizes]
    single = {g[0]: c for g, c in counts.items() if len(g) == 1}
    total = sum(single.values())
    root = lambda word: (single.get(word, 0) + 1) / (total + len(single) + 1)
    states = {g for g in counts if len(g) < order and after[g]}
    fail = {g: math.log10(discount[len(g) + 1] * after[g] / counts[g]) for g in states}

    def prob(gram):
        if len(gram) == 1:
            return root(gram[0])
        return ((counts[gram] - discount[len(gram)]) / counts[gram[:-1]]
                + 10 ** fail[gram[:-1]] * prob(gram[1:]))
    arcs = {g: math.log10(prob(g)) for g in counts if len(g) > 1}
    out = []
    for (doc_id, _), text, h in zip(rows, texts, held):
        state, score = (), 0.0
        for word in text:
            while state and (*state, word) not in arcs:
                score += fail[state]
                state = state[1:]
            score += arcs[(*state, word)] if state else math.log10(root(word))
            state = (*state, word)
            while state and state not in states:
                state = state[1:]
        base = sum(math.log10(root(word)) for word in text)
        out.append((str(doc_id), h, len(text), sum(w in single for w in text), total, round(base, 5), round(score, 5)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5))
                  for r in df.collect())


def near(df, expected):
    rows = got(df)
    assert [r[:5] for r in rows] == [r[:5] for r in expected]
    np.testing.assert_allclose([r[5:] for r in rows], [r[5:] for r in expected], rtol=1e-9, atol=2e-5)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_a_plain_automaton(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "SHARD_GRAMS", 20_000)
    docs = table(spark, SF_DIR, "documents")
    near(lm.scores(docs, order=order), brute([(r.doc_id, r.text) for r in docs.collect()], order))


def test_lanes_of_a_long_text_carry_the_state(monkeypatch):
    """Lanes of three tokens give the tokens the weights of one walk."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcd") for _ in range(k)) for k in (0, 1, 40, 500)]
    batch = pa.record_batch({"doc_id": [1, 2, 3, 4], "text": texts, "held": [False, True, False, False]})
    monkeypatch.setattr(lm, "TaskContext", type("T", (), {"get": staticmethod(
        lambda: type("C", (), {"partitionId": staticmethod(lambda: 0)}))}))
    chunk = lm.Chunk(next(lm.code_chunks(iter([batch]))).to_pylist()[0])
    levels = []
    for n in (3, 2, 1):
        grams = chunk.grams(n)
        types = np.zeros(len(grams.prints), np.int64)
        if levels:
            longer, counts, _ = levels[0]
            types = np.bincount(grams.ends[longer.place[counts > 0] - 1], minlength=len(types))
        levels.insert(0, (grams, grams.counts, types))
    total = int(levels[0][1].sum())
    machine = lm.Automaton(chunk, levels, total, int((levels[0][1] > 0).sum()), [0, 0, 0.7, 0.8])
    whole = machine.walk(chunk, 2)
    monkeypatch.setattr(lm, "LANE", 3)
    assert (machine.walk(chunk, 2) == whole).all()


def test_a_document_seen_in_training_scores_higher(spark):
    rng = random.Random(9)
    text = lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(80))
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = {i: text() for i in range(400)}
    twin, alone = out[0], out[1]
    rows[next(i for i in rows if i not in out)] = rows[twin]
    score = {r.doc_id: r.score - r.base_score for r in lm.scores(
        spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert score[twin] > score[alone] + 20


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    near(lm.scores(docs), brute(rows, lm.ORDER))
    assert lm.scores(docs.limit(0)).count() == 0
    only = docs.where("doc_id in (2, 13)")
    assert all(r.score <= 0 for r in lm.scores(only).collect())


def test_probabilities_of_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([(0, "a b a c"), (1, "a b b")], "doc_id long, text string")
    words = ["a", "b", "c", None]
    rows = [(0, "a b a c"), (1, "a b b")]
    counts = Counter(t for _, x in rows for t in tokens(x))
    assert sum((counts[w] + 1) / (sum(counts.values()) + len(counts) + 1) for w in words) < 1
    near(lm.scores(docs), brute(rows, lm.ORDER))


def test_packed_integers():
    rng = np.random.default_rng(4)
    for top in (1, 2, 255, 256, 2**40, 2**64 - 1):
        values = rng.integers(0, top, 1000, dtype=np.uint64, endpoint=True)
        assert (lm.unsqueeze(lm.squeeze(values), 1000) == values).all()
        ordered = np.sort(values)
        assert (lm.unsqueeze_sorted(lm.squeeze_sorted(ordered), 1000) == ordered).all()
    assert len(lm.unsqueeze(lm.squeeze(values[:0]), 0)) == 0


def test_ranks_that_hold_the_magic_number_of_a_frame(spark):
    """255 words whose ranks, in the order of their fingerprints, go on with 40, 181, 47, 253."""
    words = [f"w{i}" for i in range(255)]
    prints = W.split(pa.array([" ".join(words)])).prints
    by_print = [words[i] for i in np.argsort(prints)]
    rest = [r for r in range(255) if r not in (40, 181, 47, 253)]
    random.Random(6).shuffle(rest)
    at = 30
    ranks = [*rest[:at], 40, 181, 47, 253, *rest[at:]]
    text = " ".join(w for w, rank in zip(by_print, ranks) for _ in range(256 - rank))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    near(lm.scores(docs), brute([(1, text)], lm.ORDER))
