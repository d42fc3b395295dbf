import numpy as np
import pyarrow as pa

from fareledger.llm import toxicity as tox
from fareledger.llm.common import table
from tests.llm.cases import awkward


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 111, 112, 113, 1000):
        text, start, length = tox.windows(np.array([0, n, n]))
        own = text == 0
        seen = {s + k for s, m in zip(start[own], length[own]) for k in range(m)}
        assert seen == set(range(n)) and (~own).sum() == 1


def test_gradients_are_those_of_the_loss():
    net = tox.Network.fresh(1)
    e = tox.encode(pa.array(["some few words here", "other words", "x"]))
    net.p["word"] += np.random.default_rng(0).normal(0, 0.3, net.p["word"].shape).astype(np.float32)
    lengths, label = np.diff(e.first), np.array([1, 0, 1], np.float32)

    def loss():
        _, product = net.inputs(e)
        at = np.minimum(e.first[:-1] + np.arange(tox.WINDOW)[:, None], len(e.place) - 1)
        logit = net.forward(product[e.place[at]], np.arange(tox.WINDOW)[:, None] < lengths)
        p = tox._sigmoid(logit.astype(np.float64))
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))
    grads = {}
    net._step = lambda g: grads.update(g)
    net.learn(e, e.first[:-1], lengths, label)
    for name, place in {"in": (3, 5), "fore": (2, 7), "back": (1, 20), "look": (4,), "out": (9,), "bias": (30,),
                        "word": (e.bucket[0], 2), "char": (e.gram[0], 1)}.items():
        old, step = net.p[name][place], 1e-2
        net.p[name][place] = old + step
        high = loss()
        net.p[name][place] = old - step
        low = loss()
        net.p[name][place] = old
        assert abs((high - low) / (2 * step) - grads[name][place]) < 2e-3, name


def test_held_out_accuracy(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    scored = tox.toxicity(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    rank = scored.score.rank()
    ones = scored.toxic == 1
    auc = (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert auc > 0.93
    assert (scored.predicted[~ones] == 1).mean() < 0.02 and (scored.predicted[ones] == 1).mean() > 0.7


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 1, 1), (6, 1, 0), (9, 0, 0), (10, 0, 1), (None, 1, 1), (7, 0, 0), (8, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows = tox.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= tox.CUT) for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    assert tox.without_toxic(docs, labels).dtypes == docs.dtypes
    assert tox.toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in tox.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_repeated_ids_learn_the_same_text_in_any_order(spark):
    rows = [(i, f"kind words number {i}") for i in range(30)] + [(i, f"vile awful words {i}") for i in range(30, 60)]
    rows += [(3, "vile awful words again"), (40, "kind words again"), (3, None)]
    labels = spark.createDataFrame([(i, int(i >= 30)) for i in range(60)], "doc_id long, toxic int")
    nets = [tox.fit(spark.createDataFrame(order, "doc_id long, text string").repartition(n), labels)
            for order, n in ((rows, 1), (rows[::-1], 5))]
    assert all((nets[0].p[name] == nets[1].p[name]).all() for name in nets[0].p)
