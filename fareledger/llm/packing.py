"""Conflict-constrained best-fit packing of documents into training sequences.

A bin holds ``capacity`` tokens, at most one piece of each source and at most one member of each
duplicate cluster. Documents go to shards by a hash, so many that a shard stays small however
large the corpus is. A shard packs its pieces from the longest to the shortest: bins are kept in
order of their residual room with bitmaps of their sources and clusters, and the search for the
successor of a length goes on until the tightest compatible bin is found, else a bin is opened.

Defined results: a document costs its words and one end token, so null and empty texts take one
token and belong to no cluster; a null source conflicts with nothing; a document longer than a
bin fills bins of its own and its rest is packed like any other; rows that repeat an id are packed
each by itself; ties go to the smaller bin number; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.llm.common import shards, text_of
from fareledger.llm.quality_rules import words_of

CAPACITY = 2048
SHARD_ROWS = 20_000
SCAN = 256  # bins looked at in one step of a successor search
ROW = "bin_id long, place int, doc_id long, piece int, start_word long, n_tokens long, bin_tokens long"


class Bins:
    """Open bins of a shard in order of residual room."""

    def __init__(self, capacity: int, sources: int, clusters: int) -> None:
        self.capacity = capacity
        self.residual: list[int] = []
        self.order = np.zeros(0, np.int64)      # open bins by (residual, number)
        self.room = np.zeros(0, np.int64)       # their residuals
        self.source = np.zeros((1024, -(-max(sources, 1) // 64)), np.uint64)
        self.cluster = np.zeros((1024, -(-max(clusters, 1) // 64)), np.uint64)

    def _bit(self, number: int) -> tuple[int, np.uint64]:
        return number >> 6, np.uint64(1 << (number & 63))

    def tightest(self, need: int, source: int, cluster: int) -> int | None:
        """Position in the order of the tightest open bin that fits and is compatible."""
        at = int(np.searchsorted(self.room, need))
        while at < len(self.order):
            bins = self.order[at:at + SCAN]
            clash = np.zeros(len(bins), bool)
            for maps, number in ((self.source, source), (self.cluster, cluster)):
                if number >= 0:
                    word, bit = self._bit(number)
                    clash |= (maps[bins, word] & bit) != 0
            free = int(np.argmin(clash))
            if not clash[free]:
                return at + free
            at += SCAN
        return None

    def open(self) -> int:
        number = len(self.residual)
        if number == len(self.source):
            self.source = np.concatenate([self.source, np.zeros_like(self.source)])
            self.cluster = np.concatenate([self.cluster, np.zeros_like(self.cluster)])
        self.residual.append(self.capacity)
        return number

    def put(self, need: int, source: int, cluster: int) -> int:
        at = self.tightest(need, source, cluster)
        if at is None:
            number = self.open()
        else:
            number = int(self.order[at])
            self.order, self.room = np.delete(self.order, at), np.delete(self.room, at)
        for maps, x in ((self.source, source), (self.cluster, cluster)):
            if x >= 0:
                word, bit = self._bit(x)
                maps[number, word] |= bit
        self.residual[number] -= need
        left = self.residual[number]
        if left:
            low, high = np.searchsorted(self.room, [left, left + 1])
            at = low + int(np.searchsorted(self.order[low:high], number))
            self.order, self.room = np.insert(self.order, at, number), np.insert(self.room, at, left)
        return number


def numbered(values: np.ndarray, known: np.ndarray, least: int) -> tuple[np.ndarray, int]:
    """Numbers of the values that occur at least ``least`` times, -1 for the others and unknown ones."""
    _, place, count = np.unique(values, return_inverse=True, return_counts=True)
    kept = np.cumsum(count >= least) - 1
    return np.where(known & (count[place] >= least), kept[place], -1), int((count >= least).sum())


def pack_shard(doc_id: list, length: np.ndarray, source: np.ndarray, cluster: np.ndarray,
               sources: int, clusters: int, capacity: int) -> list[tuple]:
    """(bin, row, piece, start, tokens) of every piece."""
    bins = Bins(capacity, sources, clusters)
    out = []
    for row in np.flatnonzero(length > capacity):
        for piece in range(int(length[row] - 1) // capacity):
            number = bins.open()
            bins.residual[number] = 0
            out.append((number, int(row), piece, piece * capacity, capacity))
    whole = np.maximum(length - 1, 0) // capacity
    rest = length - whole * capacity
    for row in np.argsort(-rest, kind="stable"):
        number = bins.put(int(rest[row]), int(source[row]), int(cluster[row]))
        out.append((number, int(row), int(whole[row]), int(whole[row]) * capacity, int(rest[row])))
    return out


def packer(capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks().sort_by([("doc_id", "ascending"), ("cluster", "ascending")])
        length = rows["n"].to_numpy()
        known = [~rows[c].is_null().to_numpy() for c in ("source", "cluster")]
        source, n_source = numbered(rows["source"].fill_null(0).to_numpy(), known[0], 1)
        cluster, n_cluster = numbered(rows["cluster"].fill_null(0).to_numpy(), known[1], 2)
        placed = sorted(pack_shard(None, length, source, cluster, n_source, n_cluster, capacity))
        number, row, piece, start, tokens = (np.array(c, np.int64) for c in zip(*placed))
        fill = np.bincount(number, weights=tokens).astype(np.int64)
        first = np.searchsorted(number, number)
        shard = rows["shard"][0].as_py()
        yield pa.RecordBatch.from_arrays([
            pa.array((shard << 32) + number), pa.array((np.arange(len(number)) - first).astype(np.int32)),
            rows["doc_id"].combine_chunks().take(pa.array(row)), pa.array(piece.astype(np.int32)),
            pa.array(start), pa.array(tokens), pa.array(fill[number])],
            names=[f.split()[0] for f in ROW.split(", ")])
    return pack


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None,
         length: Column | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each piece of each document: its bin, place in it, span of words and tokens.

    ``cluster`` numbers groups of duplicates (by default equal texts); ``length`` counts tokens.
    """
    text = text_of()
    cluster = F.when(text != "", F.xxhash64(text)) if cluster is None else cluster
    length = F.size(words_of(text)) + 1 if length is None else length
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), length.cast("long").alias("n"),
                       F.when(F.col("source").isNotNull(), F.xxhash64("source")).alias("source"),
                       cluster.alias("cluster"))
    count = shards(docs, shard_rows)
    shard = F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(count))
    # Rows are small, so adaptive execution would put many shards into one task; a stated number stays.
    rows = rows.withColumn("shard", shard).repartition(count, "shard")
    return rows.groupBy("shard").applyInArrow(packer(capacity), ROW)
