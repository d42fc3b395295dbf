"""Language-model scores by a weighted backoff automaton, trigrams by default.

States are the root and the trained n-grams shorter than ``order`` that go on in training. An arc
reads a word and weighs the smoothed probability of that word after the state's n-gram; a failure
arc reads nothing, leads to the longest proper suffix and weighs the state's backoff. One walk over
a text from left to right carries the state: it fails until an arc reads the word (the root reads
every word), adds up the weights as log10 and goes on from the arc's target.

Smoothing is absolute discounting, interpolated: p(w | v) = (c(v w) - D) / c(v) + b(v) p(w | v')
with b(v) = D t(v) / c(v) and t(v) the number of different words after v in training. The discount
of each order is (n1 + 1) / (n1 + 2 n2 + 2) of the numbers of n-grams seen once and twice in all
training documents. The root has the add-one unigrams.

The model covers all n-grams of all training documents and is far larger than a task, so it is
never whole in one place. Texts are coded once in chunks of bounded size, bucketed by chunk. From
the longest n-grams down, a chunk asks for those it holds, as sorted fingerprints with its own
training counts; shards of the fingerprint space add them up and answer in the same order. A shard
also names one chunk as the owner of each trained n-gram, and the owners count t(v) of the order
below, each n-gram once. Then each chunk builds the part of the automaton that its texts can reach
and walks them. Many texts walk at once, a token position at a time; a long text is walked in
lanes that start ``order - 1`` tokens early at the root, after which their state is that of one
walk over the whole text, as no state remembers more.

Defined results: null and empty texts are one end token; rows are scored each by itself, repeated
and null ids included (a null id is never held out); without training documents every probability
is one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareledger.llm import words as W
from fareledger.llm.common import slices, stored
from fareledger.llm.toxicity import held_out
from fareledger.session import shared_dir

ORDER = 3
CHUNK_TOKENS = 700_000
SHARD_GRAMS = 2_000_000
LANE = 256  # tokens of a text that one lane walks
_END = np.uint64(0x5EED5EED5EED5EED)
_ZSTD = pa.Codec("zstd", 1)

CHUNKS = ("chunk long, doc_id array<long>, held array<boolean>, lengths array<int>, vocab binary, codes binary")
ASKED = "chunk long, shard int, n long, prints binary, counts binary, types binary"
ANSWERED = ("chunk long, shard int, n long, counts binary, types binary, owned binary,"
            " tokens long, distinct long, once long, twice long")
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
          " base_score double, score double")


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes, high planes that are all zero left out."""
    values = np.ascontiguousarray(values, np.uint64)
    planes = values.view(np.uint8).reshape(-1, 8)
    used = 8
    while used > 1 and not planes[:, used - 1].any():
        used -= 1
    raw = planes[:, :used].T.tobytes()
    return bytes([used]) + _ZSTD.compress(raw, asbytes=True)


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    used = data[0]
    out = np.zeros((n, 8), np.uint8)
    raw = _ZSTD.decompress(data[1:], decompressed_size=used * n, asbytes=True)
    out[:, :used] = np.frombuffer(raw, np.uint8).reshape(used, n).T
    return out.reshape(-1).view(np.uint64)


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unsqueeze(data, n), dtype=np.uint64)


def code_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of the chunk's own words, the frequent ones low."""
    seq, size, held, ids, prints, lengths = 0, 0, [], [], [], []

    def chunk() -> pa.RecordBatch:
        vocab, code, count = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        number = TaskContext.get().partitionId() * (1 << 32) + seq
        return pa.RecordBatch.from_pylist([{
            "chunk": number, "doc_id": ids, "held": held, "lengths": np.concatenate(lengths),
            "vocab": (words := squeeze_sorted(vocab)) + squeeze(rank)
                     + len(words).to_bytes(8, "little") + len(vocab).to_bytes(8, "little"),
            "codes": squeeze(rank[code])}], schema=_chunk_schema())
    for batch in batches:
        for part in slices(batch):
            words = W.split(part.column("text"))
            counts = words.counts + 1
            ends = np.cumsum(counts) - 1
            tokens = np.full(int(counts.sum()), _END, np.uint64)
            inside = np.ones(len(tokens), bool)
            inside[ends] = False
            tokens[inside] = words.prints
            prints.append(tokens)
            lengths.append(counts.astype(np.int32))
            ids += part.column("doc_id").to_pylist()
            held += part.column("held").to_pylist()
            size += len(tokens)
            if size >= CHUNK_TOKENS:
                yield chunk()
                seq, size, held, ids, prints, lengths = seq + 1, 0, [], [], [], []
    if ids:
        yield chunk()


def _chunk_schema() -> pa.Schema:
    return pa.schema([("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                      ("lengths", pa.list_(pa.int32())), ("vocab", pa.binary()), ("codes", pa.binary())])


class Chunk:
    """A coded chunk read back."""

    def __init__(self, row: dict) -> None:
        self.number = row["chunk"]
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.array(row["held"], bool)
        self.doc_id = row["doc_id"]
        n = int.from_bytes(row["vocab"][-8:], "little")
        cut = int.from_bytes(row["vocab"][-16:-8], "little")
        self.vocab = unsqueeze_sorted(row["vocab"][:cut], n)
        self.rank = unsqueeze(row["vocab"][cut:-16], n).astype(np.int64)
        self.tokens = unsqueeze(row["codes"], int(self.lengths.sum())).astype(np.int32)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.trained = np.repeat(~self.held, self.lengths)
        self.within = (np.arange(len(self.tokens)) - np.repeat(self.first, self.lengths)).astype(np.int32)

    def grams(self, n: int) -> Grams:
        size = len(self.tokens)
        if n == 1:
            of_code = np.empty(len(self.vocab), np.int32)
            of_code[self.rank] = np.arange(len(self.vocab), dtype=np.int32)
            prints, ends = self.vocab, of_code[self.tokens]
            place = np.empty(len(prints), np.int32)
            place[ends] = np.arange(size, dtype=np.int32)
        else:
            by_code = np.empty(len(self.vocab), np.uint64)
            by_code[self.rank] = self.vocab
            at = np.flatnonzero(self.within >= n - 1).astype(np.int32)
            value = np.zeros(len(at), np.uint64)
            for k in range(n - 1, -1, -1):
                value *= np.uint64(0x9E3779B97F4A7C15)
                value += by_code[self.tokens[at - k]]
                value = W.mix(value)
            order = np.argsort(value)
            value = value[order]
            new = np.append(True, value[1:] != value[:-1])[:len(value)]
            prints, at = value[new], at[order]
            place = at[new]
            ends = np.full(size, -1, np.int32)
            ends[at] = (np.cumsum(new) - 1).astype(np.int32)
        counts = np.bincount(ends[self.trained & (ends >= 0)], minlength=len(prints))
        return Grams(prints, counts, place, ends)


@dataclass
class Grams:
    """Distinct n-grams of a chunk, by rising fingerprint."""

    prints: np.ndarray
    counts: np.ndarray  # training occurrences in the chunk
    place: np.ndarray   # a token that ends each of them
    ends: np.ndarray    # the n-gram that ends at each token, or -1


def shard_edges(prints: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's share of sorted fingerprints begins."""
    top = [np.uint64((k << 64) // shards) for k in range(shards)]
    return np.append(np.searchsorted(prints, np.array(top, np.uint64)), len(prints))


def questions(chunk: Chunk, grams: Grams, types: np.ndarray, shards: int) -> pa.Table:
    """A row for each shard that a chunk's n-grams fall in."""
    edges = shard_edges(grams.prints, shards)
    cuts = [(k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
    packed = lambda pack, x: pa.array([pack(x[a:b]) for _, a, b in cuts], pa.binary())
    return pa.table({
        "chunk": pa.array([chunk.number] * len(cuts), pa.int64()), "shard": pa.array([k for k, _, _ in cuts], pa.int32()),
        "n": pa.array([int(b - a) for _, a, b in cuts], pa.int64()), "prints": packed(squeeze_sorted, grams.prints),
        "counts": packed(squeeze, grams.counts), "types": packed(squeeze, types)})


def longest_asker(order: int, shards: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.slice(i, 1).to_pylist()[0])
                grams = chunk.grams(order)
                yield from questions(chunk, grams, np.zeros(len(grams.prints), np.int64), shards).to_batches()
    return ask


def shorter_asker(n: int, shards: int):
    """Questions for n-grams, with the number of owned longer ones that each of them begins."""
    def ask(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(chunks.to_pylist()[0])
        grams, longer = chunk.grams(n), chunk.grams(n + 1)
        replies = sorted(answers.to_pylist(), key=lambda r: r["shard"])
        owned = np.concatenate([unpack_bits(r["owned"], r["n"]) for r in replies] or [np.zeros(0, bool)])
        types = np.bincount(grams.ends[longer.place[owned] - 1], minlength=len(grams.prints))
        return questions(chunk, grams, types, shards)
    return ask


def pack_bits(bits: np.ndarray) -> bytes:
    return squeeze(np.packbits(bits))


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(unsqueeze(data, -(-n // 8)).astype(np.uint8), count=n).astype(bool)


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over all chunks, in the order in which each chunk has asked."""
    rows = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda row: row["chunk"])
    asked = np.concatenate([unsqueeze_sorted(row["prints"], row["n"]) for row in rows])
    order = np.argsort(asked)
    ranked = asked[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    of = np.empty(len(asked), np.int64)
    of[order] = np.cumsum(new) - 1
    del ranked, asked
    counts, types = (np.concatenate([unsqueeze(row[name], row["n"]) for row in rows]).astype(np.int64)
                     for name in ("counts", "types"))
    first = np.flatnonzero(new)
    totals, kinds = (np.add.reduceat(x[order], first) for x in (counts, types))
    trained = order[counts[order] > 0]  # by n-gram: the first asker of each owns it
    owner = np.zeros(len(of), bool)
    owner[trained[np.append(True, of[trained[1:]] != of[trained[:-1]])[:len(trained)]]] = True
    sums = [int(x) for x in (totals.sum(), (totals > 0).sum(), (totals == 1).sum(), (totals == 2).sum())]
    at = 0
    for row in rows:
        own = slice(at, at + row["n"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["chunk"]]), pa.array([row["shard"]], pa.int32()), pa.array([row["n"]]),
             pa.array([squeeze(totals[of[own]])], pa.binary()), pa.array([squeeze(kinds[of[own]])], pa.binary()),
             pa.array([pack_bits(owner[own])], pa.binary()), *(pa.array([x if at == 0 else 0]) for x in sums)],
            names=["chunk", "shard", "n", "counts", "types", "owned", "tokens", "distinct", "once", "twice"])
        at += row["n"]


class Automaton:
    """The part of the automaton that the texts of one chunk can reach.

    State 0 is the root; each n-gram of the chunk shorter than the order has a number after it.
    """

    def __init__(self, chunk: Chunk, levels: list[tuple[Grams, np.ndarray, np.ndarray]], tokens: int,
                 distinct: int, discounts: list[float]) -> None:
        order, self.words = len(levels), len(chunk.vocab)
        base = np.cumsum([0, 1, *(len(counts) for _, counts, _ in levels)])  # first state of each length
        states = int(base[order]) if order > 1 else 1
        self.fail_to, self.fail_weight = np.zeros(states, np.int64), np.zeros(states)
        self.root_to, self.root_weight = np.zeros(self.words, np.int64), np.zeros(self.words)
        keys, targets, weights = [], [], []
        for n, (grams, counts, types) in enumerate(levels, start=1):
            seen = np.flatnonzero(counts)
            if n == 1:
                prob = (counts + 1) / (tokens + distinct + 1)
                word = chunk.tokens[grams.place]
                self.root_weight[word] = np.log10(prob)
                self.root_to[word] = np.where((counts > 0) & (order > 1), base[1] + np.arange(len(counts)), 0)
                suffix = np.full(len(counts), -1)
            else:
                last = grams.place
                prefix, suffix = shorter.ends[last - 1].astype(np.int64), shorter.ends[last].astype(np.int64)
                own, past = prefix[seen], suffix[seen]
                prob = np.zeros(len(counts))
                prob[seen] = (counts[seen] - discounts[n]) / below[own] + back[own] * prob_below[past]
                keys.append(W.mix((base[n - 1] + own) * self.words + chunk.tokens[last[seen]]))
                targets.append((base[n] + seen if n < order else base[n - 1] + past).astype(np.int32))
                weights.append(np.log10(prob[seen]))
            if n < order:
                back = discounts[n + 1] * types / np.maximum(counts, 1)
                on = np.flatnonzero(types)
                self.fail_to[base[n] + on] = base[n - 1] + suffix[on] if n > 1 else 0
                self.fail_weight[base[n] + on] = np.log10(back[on])
            shorter, below, prob_below = grams, counts, prob
        # Arcs by the scrambled key, with the first arc of each range of keys: one or two looks find one.
        mixed = np.concatenate(keys or [np.zeros(0, np.uint64)])
        by_key = np.argsort(mixed)
        self.keys = mixed[by_key]
        self.to = np.concatenate(targets or [np.zeros(0, np.int32)])[by_key]
        self.weight = np.concatenate(weights or [np.zeros(0)])[by_key]
        bits = max(1, len(mixed).bit_length())
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)

    def arcs(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The arc of each state that reads the word, or -1."""
        key = W.mix(state * self.words + word)
        cell = (key >> self.shift).astype(np.int64)
        at, stop = self.begin[cell], self.begin[cell + 1]
        out = np.full(len(key), -1)
        left = np.flatnonzero(at < stop)
        while len(left):
            met = self.keys[at[left]] == key[left]
            out[left[met]] = at[left[met]]
            left = left[~met]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out

    def read(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights on the way, and the states after each word has been read."""
        gain, at, after = np.zeros(len(state)), state.copy(), np.full(len(state), -1)
        left = np.flatnonzero(at)
        while len(left):
            arc = self.arcs(at[left], word[left])
            met = arc >= 0
            hit, arc = left[met], arc[met]
            gain[hit] += self.weight[arc]
            after[hit] = self.to[arc]
            left = left[~met]
            gain[left] += self.fail_weight[at[left]]
            at[left] = self.fail_to[at[left]]
            left = left[at[left] > 0]
        root = after < 0
        gain[root] += self.root_weight[word[root]]
        after[root] = self.root_to[word[root]]
        return gain, after

    def walk(self, chunk: Chunk, memory: int) -> np.ndarray:
        """Log10 probability of each token, read from left to right with the state carried."""
        lanes = -(-chunk.lengths // LANE)
        part = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = np.repeat(chunk.first, lanes) + part * LANE
        stop = np.minimum(start + LANE, np.repeat(chunk.first + chunk.lengths, lanes))
        begin = start - np.minimum(part * LANE, memory)
        order = np.argsort(begin - stop, kind="stable")
        begin, start, length = begin[order], start[order], (stop - begin)[order]
        state, out = np.zeros(len(begin), np.int64), np.zeros(len(chunk.tokens))
        for step in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -step, side="left"))
            at = begin[:live] + step
            gain, state[:live] = self.read(state[:live], chunk.tokens[at])
            mine = at >= start[:live]
            out[at[mine]] = gain[mine]
        return out


def walker(order: int, tokens: int, distinct: int, discounts: list[float]):
    def walk(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(chunks.to_pylist()[0])
        levels = []
        for n in range(1, order + 1):
            replies = sorted(answers.filter(pc.equal(answers.column("level"), n)).to_pylist(), key=lambda r: r["shard"])
            counts, types = (np.concatenate([unsqueeze(r[name], r["n"]) for r in replies] or [[]]).astype(np.int64)
                             for name in ("counts", "types"))
            grams = chunk.grams(n)
            grams.prints = grams.prints[:0]  # not needed any more
            levels.append((grams, counts, types))
        words, counts, _ = levels[0]
        seen = counts[words.ends]
        gains = Automaton(chunk, levels, tokens, distinct, discounts).walk(chunk, order - 1)
        add = lambda values: np.add.reduceat(values, chunk.first)
        return pa.table({
            "doc_id": pa.array(chunk.doc_id, pa.int64()), "held_out": pa.array(chunk.held),
            "n_tokens": chunk.lengths, "n_known": add((seen > 0).astype(np.int64)),
            "train_tokens": np.full(len(chunk.lengths), tokens),
            "base_score": add(np.log10((seen + 1) / (tokens + distinct + 1))), "score": add(gains)})
    return walk


def bucketed(chunks: DataFrame) -> DataFrame:
    """Chunks written once in buckets, so that meeting their answers moves the answers only."""
    spark = chunks.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_chunks_{uuid.uuid4().hex}"
    (chunks.repartition(buckets, "chunk").write.bucketBy(buckets, "chunk")
     .option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name))
    return spark.table(name)


def scores(docs: DataFrame, folds: int = 7, fold: int = 2, order: int = ORDER) -> DataFrame:
    """One row per document: SCORES. Documents of the fold are scored but not learnt from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(F.col("doc_id"), folds, fold).alias("held"))
    chunks = bucketed(rows.mapInArrow(code_chunks, CHUNKS))
    total = chunks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n))).first()[0] or 0
    shards = max(1, -(-total // SHARD_GRAMS))
    by_chunk = chunks.groupBy("chunk")
    replies, reply, discounts = None, None, [0.0] * (order + 1)
    for n in range(order, 0, -1):
        asked = (chunks.mapInArrow(longest_asker(n, shards), ASKED) if reply is None else
                 by_chunk.cogroup(reply.select("chunk", "shard", "n", "owned").groupBy("chunk"))
                 .applyInArrow(shorter_asker(n, shards), ASKED))
        reply = stored(asked.groupBy("shard").applyInArrow(answer, ANSWERED).withColumn("level", F.lit(n)))
        tokens, distinct, once, twice = (x or 0 for x in reply.agg(
            *(F.sum(c) for c in ("tokens", "distinct", "once", "twice"))).first())
        discounts[n] = (once + 1) / (once + 2 * twice + 2)
        replies = reply if replies is None else replies.unionByName(reply)
    facts = replies.select("chunk", "shard", "n", "counts", "types", "level")
    return by_chunk.cogroup(facts.groupBy("chunk")).applyInArrow(walker(order, tokens, distinct, discounts), SCORES)
