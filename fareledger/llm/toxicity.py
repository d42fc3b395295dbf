"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own hashed embedding beside the mean embedding of its character 4-grams, so
an unseen form of a known root is recognised. Both directions run over windows of ``WINDOW`` words
that overlap by a quarter and cover the whole text; attention pools each window's states to one logit,
and a document scores as its most toxic window. Training picks that window of each document anew
in every epoch, for a document's label only says that some window is toxic.

Defined results: null, empty and blank texts are one window without words and score the network's
answer to nothing; without labels of both kinds every score is the share of toxic labels, zero
if there are none; rows are scored each by itself, repeated or null ids included; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.llm import words as W
from fareledger.llm.common import slices, text_of

WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 14
#: Labelled documents of each class to learn from, at most; drawn by a hash of their ids.
SAMPLE = 2500
EPOCHS, BATCH, RATE = 10, 64, 0.01
PICKED = (0, 1, 3, 6)  # epochs that pick each document's window anew
SCORED = 2048  # windows scored at once
CUT = 0.3
_FOUR = np.array([1, 257, 66049, 16974593], np.uint64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _add_rows(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add each row of ``values`` to a row of ``out``; rows may repeat."""
    if len(rows):
        order = np.argsort(rows, kind="stable")
        ordered = rows[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        out[ordered[first]] += np.add.reduceat(values[order], first)


@dataclass
class Encoded:
    """Words of some texts as distinct words and places."""

    place: np.ndarray      # distinct word of each word
    first: np.ndarray      # first word of each text
    bucket: np.ndarray     # embedding row of each distinct word
    gram: np.ndarray       # embedding row of each character 4-gram of the distinct words
    gram_first: np.ndarray


def encode(texts: pa.Array) -> Encoded:
    words = W.split(texts)
    distinct, at, place = np.unique(words.prints, return_index=True, return_inverse=True)
    data = np.where((words.data >= 65) & (words.data <= 90), words.data + 32, words.data)
    lengths = words.stop[at] - words.start[at]
    # Each distinct word between marks: two before, one after, so even one byte has a 4-gram.
    place_of = np.concatenate([[0], np.cumsum(lengths + 3)])
    marked = np.full(place_of[-1], 2, np.uint64)
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    marked[inner + np.repeat(place_of[:-1] + 2, lengths)] = data[inner + np.repeat(words.start[at], lengths)]
    marked[place_of[1:] - 1] = 3
    rolled = sum(marked[k:len(marked) - 3 + k] * _FOUR[k] for k in range(4)) if len(marked) else marked
    counts = lengths.copy()
    begin = np.cumsum(counts) - counts
    source = np.arange(int(counts.sum())) - np.repeat(begin, counts) + np.repeat(place_of[:-1], counts)
    return Encoded(place, words.first, (distinct % np.uint64(WORD_ROWS)).astype(np.int64),
                   (W.mix(rolled[source]) % np.uint64(CHAR_ROWS)).astype(np.int64), begin)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and length of every window; together they cover every word of every text."""
    count = np.diff(first)
    number = np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(count)), number)
    k = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    start = np.minimum(k * STRIDE, np.maximum(count[text] - WINDOW, 0))
    return text, first[text] + start, np.minimum(count[text], WINDOW)


@dataclass
class Network:
    """Weights by name; the two directions share an input product and have their own recurrence."""

    p: dict[str, np.ndarray]
    shift: float = 0.0
    prior: float | None = None
    moments: dict = field(default_factory=dict)
    steps: int = 0

    @staticmethod
    def fresh(seed: int = 3) -> "Network":
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        return Network({
            "word": np.zeros((WORD_ROWS, WORD_DIM), np.float32),
            "char": rng.normal(0, 0.1, (CHAR_ROWS, CHAR_DIM)).astype(np.float32),
            "in": draw(WORD_DIM + CHAR_DIM, 6 * HIDDEN), "bias": np.zeros(6 * HIDDEN, np.float32),
            "fore": draw(HIDDEN, 3 * HIDDEN), "back": draw(HIDDEN, 3 * HIDDEN),
            "look": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "base": np.zeros(1, np.float32)})

    def inputs(self, e: Encoded) -> tuple[np.ndarray, np.ndarray]:
        """Vector of each distinct word, and its product with the input weights."""
        chars = np.zeros((len(e.bucket), CHAR_DIM), np.float32)
        if len(e.bucket):
            sums = np.add.reduceat(self.p["char"][e.gram], e.gram_first)
            chars = sums / np.diff(np.append(e.gram_first, len(e.gram)))[:, None].astype(np.float32)
        x = np.concatenate([self.p["word"][e.bucket], chars], axis=1)
        return x, x @ self.p["in"] + self.p["bias"]

    def _run(self, gates: np.ndarray, mask: np.ndarray, weights: np.ndarray, keep: list | None) -> np.ndarray:
        h = np.zeros((gates.shape[1], HIDDEN), np.float32)
        out = np.empty((*gates.shape[:2], HIDDEN), np.float32)
        half = np.float32(0.5)
        for t in range(len(gates)):
            u = h @ weights
            zr = u[:, :2 * HIDDEN] + gates[t, :, :2 * HIDDEN]
            zr *= half
            np.tanh(zr, out=zr)  # the logistic function by way of tanh, in place
            zr *= half
            zr += half
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = r * u[:, 2 * HIDDEN:]
            n += gates[t, :, 2 * HIDDEN:]
            np.tanh(n, out=n)
            new = h - n
            new *= z
            new += n
            if keep is not None:
                keep.append((h, z, r, n, u[:, 2 * HIDDEN:]))
            h = new if mask is None else np.where(mask[t][:, None], new, h)
            out[t] = h
        return out

    def forward(self, gates: np.ndarray, mask: np.ndarray | None, tape: dict | None = None) -> np.ndarray:
        """Logit of each window from gates (time, window, both directions' inputs)."""
        half = 3 * HIDDEN
        keep = ([], []) if tape is not None else (None, None)
        back_mask = None if mask is None else mask[::-1]
        fore = self._run(gates[:, :, :half], mask, self.p["fore"], keep[0])
        back = self._run(gates[::-1, :, half:], back_mask, self.p["back"], keep[1])[::-1]
        states = np.concatenate([fore, back], axis=2)
        look = states @ self.p["look"]
        if mask is not None:
            look = np.where(mask, look, np.float32(-1e9))
        weight = np.exp(look - look.max(axis=0))
        if mask is not None:
            weight = weight * mask
        weight = weight / np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tb,tbh->bh", weight, states)
        if tape is not None:
            tape.update(keep=keep, states=states, weight=weight, pooled=pooled, mask=mask)
        return pooled @ self.p["out"] + self.p["base"][0]

    def _unrun(self, tape: list, dout: np.ndarray, mask: np.ndarray, weights: np.ndarray):
        dgates, dw = np.empty((len(tape), dout.shape[1], 3 * HIDDEN), np.float32), np.zeros_like(weights)
        dh = np.zeros(dout.shape[1:], np.float32)
        for t in reversed(range(len(tape))):
            h, z, r, n, un = tape[t]
            m = mask[t][:, None]
            total = dh + dout[t]
            d = np.where(m, total, 0)
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            dgates[t] = np.concatenate([dz, dr, dn], axis=1)
            dw += h.T @ du
            dh = d * z + du @ weights.T + np.where(m, 0, total)
        return dgates, dw

    def learn(self, e: Encoded, text_start: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> None:
        x, product = self.inputs(e)
        at = np.minimum(text_start + np.arange(WINDOW)[:, None], max(len(e.place) - 1, 0))
        mask = np.arange(WINDOW)[:, None] < lengths
        places = e.place[at]
        tape: dict = {}
        logit = self.forward(product[places], mask, tape)
        dlogit = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
        states, weight, pooled = tape["states"], tape["weight"], tape["pooled"]
        g = {"out": pooled.T @ dlogit, "base": np.array([dlogit.sum()], np.float32)}
        dpooled = dlogit[:, None] * self.p["out"]
        dweight = np.einsum("bh,tbh->tb", dpooled, states)
        dlook = weight * (dweight - (weight * dweight).sum(axis=0))
        dstates = weight[:, :, None] * dpooled + dlook[:, :, None] * self.p["look"]
        g["look"] = np.einsum("tb,tbh->h", dlook, states)
        fore, g["fore"] = self._unrun(tape["keep"][0], dstates[:, :, :HIDDEN], mask, self.p["fore"])
        back, g["back"] = self._unrun(tape["keep"][1], dstates[::-1, :, HIDDEN:], mask[::-1], self.p["back"])
        dproduct = np.zeros_like(product)
        _add_rows(dproduct, places[mask], np.concatenate([fore, back[::-1]], axis=2)[mask])
        g["in"], g["bias"] = x.T @ dproduct, dproduct.sum(axis=0)
        dx = dproduct @ self.p["in"].T
        g["word"] = np.zeros_like(self.p["word"])
        _add_rows(g["word"], e.bucket, dx[:, :WORD_DIM])
        grams = np.diff(np.append(e.gram_first, len(e.gram)))
        g["char"] = np.zeros_like(self.p["char"])
        _add_rows(g["char"], e.gram, np.repeat(dx[:, WORD_DIM:] / grams[:, None], grams, axis=0))
        self._step(g)

    def _step(self, grads: dict[str, np.ndarray]) -> None:
        """Adam."""
        self.steps += 1
        for name, g in grads.items():
            m, v = self.moments.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.001) * (g * g - v)
            rate = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            self.p[name] -= np.float32(rate) * m / (np.sqrt(v) + np.float32(1e-8))

    def window_logits(self, e: Encoded) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, start, length and logit of every window of every text."""
        text, start, length = windows(e.first)
        _, product = self.inputs(e)
        if not len(e.place):
            product, place = np.zeros((1, 6 * HIDDEN), np.float32), np.zeros(1, np.int64)
        else:
            place = e.place
        logit = np.empty(len(text), np.float32)
        full = length == WINDOW
        for group in (np.flatnonzero(full), np.flatnonzero(~full)):
            group = group[np.argsort(length[group], kind="stable")]
            for low in range(0, len(group), SCORED):
                own = group[low:low + SCORED]
                steps = max(1, int(length[own].max()))
                at = np.minimum(start[own] + np.arange(steps)[:, None], len(place) - 1)
                mask = None if full[own[0]] else np.arange(steps)[:, None] < length[own]
                logit[own] = self.forward(product[place[at]], mask)
        return text, start, length, logit

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        if not len(texts):
            return np.zeros(0)
        e = encode(texts)
        text, _, _, logit = self.window_logits(e)
        most = np.maximum.reduceat(logit, np.searchsorted(text, np.arange(len(texts))))
        return _sigmoid(most.astype(np.float64) + self.shift)


def train(texts: pa.Array, toxic: np.ndarray, share: float, seed: int = 3) -> Network:
    """A network learnt from labelled texts; ``share`` is the share of toxic ones it will meet."""
    net = Network.fresh(seed)
    if not 0 < toxic.mean() < 1:
        net.prior = float(share)
        return net
    rng = np.random.default_rng(seed)
    parts = [encode(part.column("text")) for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]))]
    labels = np.split(toxic.astype(np.float32), np.cumsum([len(e.first) - 1 for e in parts])[:-1])
    sample = toxic.mean()
    for epoch in range(EPOCHS):
        if epoch in PICKED:
            picked = [_pick(net, e, rng if epoch == 0 else None) for e in parts]
            e = _join([own for own, _ in picked])
            label = np.concatenate([known[text] for known, (_, text) in zip(labels, picked)])
            lengths = np.diff(e.first)
        order = rng.permutation(len(label))
        for low in range(0, len(order), BATCH):
            own = order[low:low + BATCH]
            net.learn(_only(e, e.first[own], lengths[own]), np.cumsum(lengths[own]) - lengths[own], lengths[own],
                      label[own])
    net.moments = {}
    net.shift = float(np.log(share / (1 - share)) - np.log(sample / (1 - sample)))
    return net


def _pick(net: Network, e: Encoded, rng: np.random.Generator | None) -> tuple[Encoded, np.ndarray]:
    """The most toxic window of each text that has words (any window before there is a network)."""
    text, start, length, logit = net.window_logits(e)
    order = np.lexsort((-logit if rng is None else rng.random(len(logit)), text))
    best = order[np.searchsorted(text[order], np.arange(len(e.first) - 1))]
    best = best[length[best] > 0]
    return _only(e, start[best], length[best]), text[best]


def _join(parts: list[Encoded]) -> Encoded:
    """Several encodings as one."""
    words, distinct, grams = (np.cumsum([0, *n]) for n in (
        [len(e.place) for e in parts], [len(e.bucket) for e in parts], [len(e.gram) for e in parts]))
    return Encoded(np.concatenate([e.place + d for e, d in zip(parts, distinct)]),
                   np.append(np.concatenate([e.first[:-1] + w for e, w in zip(parts, words)]), words[-1]),
                   np.concatenate([e.bucket for e in parts]), np.concatenate([e.gram for e in parts]),
                   np.concatenate([e.gram_first + g for e, g in zip(parts, grams)]))


def _only(e: Encoded, start: np.ndarray, length: np.ndarray) -> Encoded:
    """The words of some windows as texts of their own."""
    inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    distinct, place = np.unique(e.place[inner + np.repeat(start, length)], return_inverse=True)
    ends = np.append(e.gram_first, len(e.gram))
    counts = ends[distinct + 1] - ends[distinct]
    begin = np.cumsum(counts) - counts
    source = np.arange(int(counts.sum())) - np.repeat(begin, counts) + np.repeat(ends[distinct], counts)
    return Encoded(place, np.concatenate([[0], np.cumsum(length)]), e.bucket[distinct], e.gram[source], begin)


def held_out(doc_id: Column, folds: int, fold: int = 2) -> Column:
    """Whether crc32 of the id as text falls in the fold; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def trainer(share: float):
    """Learns from all rows of its one task and returns the network as bytes."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            drawn = pa.Table.from_batches(held).sort_by("doc_id")
            net = train(drawn["text"].combine_chunks(), drawn["toxic"].to_numpy(), share)
            yield pa.record_batch({"network": pa.array([pickle.dumps(net)], pa.binary())})
    return learn


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Learn from at most ``sample`` labelled documents of each class, none of them held out.

    Only ids and labels are compared to draw the sample, so the texts of all other documents
    stay where they are; the share of toxic labels is counted over all of them. Of texts that share
    a drawn id the one with the least hash is taken. One task learns; the driver sees the network,
    whose size does not depend on the texts.
    """
    known = (labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"), 4))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    drawn = [known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toArrow()
             for kind in (0, 1)]
    ids = pa.concat_tables(drawn)
    texts = (docs.select("doc_id", text_of().alias("text"))
             .join(docs.sparkSession.createDataFrame(ids), "doc_id")
             .groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"),
                                    F.max("toxic").alias("toxic")))
    learnt = texts.repartition(1).mapInArrow(trainer(share), "network binary").collect()
    if not learnt:  # no labelled text: a network without a sample gives the share of toxic labels
        return train(pa.array([], pa.string()), np.zeros(1), share)
    return pickle.loads(learnt[0]["network"])


def scorer(net: Network):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                scores = net.score(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())],
                                                 names=["doc_id", "score"])
    return score


def keeper(net: Network, cut: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                yield part.filter(pa.array(net.score(part.column("text")) < cut))
    return keep


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    net = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(scorer(net), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, with all their columns."""
    return docs.mapInArrow(keeper(fit(docs, labels), cut), docs.schema)
