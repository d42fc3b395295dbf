"""Token-id files of patched frame-of-reference blocks.

A file holds the ids of a range of documents in ascending order. A block is ``BLOCK`` ids: its
minimum is subtracted, the rest is packed at the width that ``PERCENTILE`` of the block's ids fit
in, and the high bits of the others are kept in an exception list. Behind the blocks stand the
index of block starts, the documents with their numbers of ids, and a footer, so any run of ids is
read by its blocks alone.

Layout, little-endian: for each block ``minimum u32, width u8, 0 u8, exceptions u16``, ``width``
rows of 16 u64 words, exception places u16, exception high bits u32; then block starts u64, for
each document ``doc_id i64``, ``known u8`` and ``ids u64``; then ``blocks, documents, ids, index
start`` as u64 and the magic number.

Texts are range-partitioned by id, so the order of the files is the order of the documents. Tasks
write through the file system that the shared folder's URI names, each attempt under a name of its
own; the stored list of files says which attempt counts. Retried or doubled attempts leave a file
that nobody lists.

Defined results: null and empty texts are the end id alone; a special token that is written out in a
text is that token's id, as the tokenizer has it by itself; rows that repeat an id follow each
other in the order of a hash of their text; rows without an id come first; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareledger.llm import words as W
from fareledger.llm.common import shards, slices, stored
from fareledger.session import shared_dir

BLOCK, LANES = 1024, 16
PERCENTILE = 0.95
END = 0
FILE_DOCS = 5000        # documents of a file, about
CACHE_PIECES = 1_200_000  # pieces whose ids a worker keeps at once
SLICE_BYTES = 3 << 20
READ_BLOCKS = 512
_HEAD = struct.Struct("<IBBH")
_FOOT = struct.Struct("<QQQQ8s")
_MAGIC = b"PFORIDS1"


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Blocks x BLOCK values below 2^width as blocks x (width * LANES) words, a lane a column."""
    lanes = values.reshape(len(values), BLOCK // LANES, LANES).astype(np.uint64)
    out = np.zeros((len(values), width, LANES), np.uint64)
    for j in range(BLOCK // LANES):
        word, shift = divmod(j * width, 64)
        out[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return out.reshape(len(values), width * LANES)


def unpack_bits(words: np.ndarray, width: int) -> np.ndarray:
    words = words.reshape(len(words), width, LANES)
    out = np.zeros((len(words), BLOCK // LANES, LANES), np.uint64)
    for j in range(BLOCK // LANES):
        word, shift = divmod(j * width, 64)
        out[:, j] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    return (out & np.uint64((1 << width) - 1)).reshape(len(words), BLOCK).astype(np.uint32)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Each row of BLOCK ids as the bytes of its block."""
    least = ids.min(axis=1).astype(np.uint32)
    rest = ids - least[:, None]
    bits = np.zeros(rest.shape, np.uint8)
    bits[...] = np.frexp(rest.astype(np.float64))[1]  # bits that a value needs
    rank = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = np.partition(bits, rank, axis=1)[:, rank]
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        low = rest[rows] & np.uint32((1 << int(w)) - 1)
        words = pack_bits(low, int(w)) if w else np.zeros((len(rows), 0), np.uint64)
        for row, packed in zip(rows, words):
            place = np.flatnonzero(bits[row] > w)
            high = rest[row, place] >> np.uint32(w)
            out[row] = (_HEAD.pack(int(least[row]), int(w), 0, len(place)) + packed.tobytes()
                        + place.astype("<u2").tobytes() + high.astype("<u4").tobytes())
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``data``."""
    heads = [_HEAD.unpack_from(data, int(s)) for s in starts]
    width = np.array([h[1] for h in heads])
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            size = int(w) * LANES
            words = np.stack([np.frombuffer(data, "<u8", size, int(starts[r]) + _HEAD.size) for r in rows])
            out[rows] = unpack_bits(words, int(w))
        for r in rows:
            if n := heads[r][3]:
                at = int(starts[r]) + _HEAD.size + int(w) * LANES * 8
                place = np.frombuffer(data, "<u2", n, at)
                out[r, place] |= np.frombuffer(data, "<u4", n, at + 2 * n) << np.uint32(w)
    return out + np.array([h[0] for h in heads], np.uint32)[:, None]


class Encoder:
    """Ids of texts by the tokenizer, each distinct piece encoded once.

    A piece begins at a space between two other bytes that are not blanks. The tokenizer splits
    there in any case and merges nothing across, so pieces have the ids they have in their text.
    Special tokens hold no space, so each lies whole in one piece. Written files take them as the
    tokenizer does by itself (``markers``); without it they are encoded like any other text.
    """

    def __init__(self, path: str, markers: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not markers
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.first = np.zeros(1, np.int64)   # where the ids of each known piece begin
        self.flat = np.zeros(0, np.uint32)   # ids of all known pieces
        self.total = 0

    def _room(self, ids: int, pieces: int) -> None:
        """Let the tables grow by doubling."""
        if self.total + ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(self.total + 2 * ids, np.uint32)])
        if len(self.known) + pieces + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros(len(self.known) + 2 * pieces, np.int64)])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, an end id behind each, and the number of ids of each text."""
        data, at = W.buffers(texts)
        blank = W.is_space(data)
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-2] = (data[1:-1] == 0x20) & ~blank[:-2] & ~blank[2:] if len(data) > 2 else False
        # At a text's first byte a piece begins, at its last none does: nothing follows there.
        some = at[:-1] < at[1:]
        begins[at[1:][some] - 1] = False
        begins[at[:-1][some]] = True
        start = np.flatnonzero(begins)
        stop = np.append(start[1:], len(data))
        prints = W.prints(data, start, stop, W.EXACT)
        distinct, where, place = np.unique(prints, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE_PIECES:
            self._clear()
        number = np.fromiter(map(self.known.get, distinct.tolist(), repeat(-1)), np.int64, len(distinct))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            raw, at_fresh = data.tobytes(), where[fresh]
            pieces = [raw[a:b].decode() for a, b in zip(start[at_fresh].tolist(), stop[at_fresh].tolist())]
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            self._room(int(sizes.sum()), len(fresh))
            base = len(self.known)
            self.flat[self.total:self.total + int(sizes.sum())] = np.fromiter(
                chain.from_iterable(encoded), np.uint32, int(sizes.sum()))
            self.first[base + 1:base + 1 + len(fresh)] = self.total + np.cumsum(sizes)
            self.total += int(sizes.sum())
            number[fresh] = np.arange(base, base + len(fresh))
            self.known.update(zip(distinct[fresh].tolist(), range(base, base + len(fresh))))
        flat, first, number = self.flat, self.first, number[place]
        sizes = first[number + 1] - first[number]
        piece_of_text = np.searchsorted(start, at)
        before = np.concatenate([[0], np.cumsum(sizes)])
        counts = before[piece_of_text[1:]] - before[piece_of_text[:-1]] + 1
        ends = np.cumsum(counts) - 1
        out = np.full(int(counts.sum()), END, np.uint32)
        inside = np.ones(len(out), bool)
        inside[ends] = False
        within = np.arange(int(sizes.sum())) - np.repeat(before[:-1], sizes)
        out[inside] = flat[np.repeat(first[number], sizes) + within]
        return out, counts


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """The worker's encoder; what it knows serves the worker's later tasks too."""
    return Encoder(path, markers=True)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Writer:
    """One file, written block by block."""

    def __init__(self, path: str) -> None:
        where, name = _open(path)
        where.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out = where.open_output_stream(name)
        self.at, self.total, self.left = 0, 0, np.zeros(0, np.uint32)
        self.starts: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, doc_id: pa.Array, counts: np.ndarray) -> None:
        self.docs.append((doc_id.fill_null(0).to_numpy(), doc_id.is_valid().to_numpy(False), counts))
        self.total += len(ids)
        self.left = np.concatenate([self.left, ids])
        whole = len(self.left) // BLOCK * BLOCK
        self._write(self.left[:whole])
        self.left = self.left[whole:]

    def _write(self, ids: np.ndarray) -> None:
        for low in range(0, len(ids), READ_BLOCKS * BLOCK):
            for block in encode_blocks(ids[low:low + READ_BLOCKS * BLOCK].reshape(-1, BLOCK)):
                self.starts.append(self.at)
                self.out.write(block)
                self.at += len(block)

    def close(self) -> None:
        if len(self.left):
            self._write(np.pad(self.left, (0, BLOCK - len(self.left)), mode="edge"))
        doc_id, known, counts = (np.concatenate(x) for x in zip(*self.docs))
        self.out.write(np.array(self.starts, "<u8").tobytes() + doc_id.astype("<i8").tobytes()
                       + known.astype(np.uint8).tobytes() + counts.astype("<u8").tobytes())
        self.out.write(_FOOT.pack(len(self.starts), len(doc_id), self.total, self.at, _MAGIC))
        self.out.close()


class Reader:
    """One file, read by the blocks that a run of ids needs."""

    def __init__(self, path: str) -> None:
        where, name = _open(path)
        self.file = where.open_input_file(name)
        size = self.file.size()
        blocks, docs, self.total, at, magic = _FOOT.unpack(self.file.read_at(_FOOT.size, size - _FOOT.size))
        if magic != _MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        index = self.file.read_at(size - _FOOT.size - at, at)
        self.starts = np.append(np.frombuffer(index, "<u8", blocks), at).astype(np.int64)
        self.doc_id = np.frombuffer(index, "<i8", docs, 8 * blocks)
        self.known = np.frombuffer(index, np.uint8, docs, 8 * (blocks + docs)).astype(bool)
        self.counts = np.frombuffer(index, "<u8", docs, 8 * (blocks + docs) + docs).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        first, last = start // BLOCK, -(-stop // BLOCK)
        if first >= last:
            return np.zeros(0, np.uint32)
        base = int(self.starts[first])
        data = self.file.read_at(int(self.starts[last]) - base, base)
        return decode_blocks(data, self.starts[first:last] - base).reshape(-1)[start - first * BLOCK:stop - first * BLOCK]


FILES = "part long, path string, n_ids long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def file_writer(folder: str, tokenizer: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, encoder = None, None
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.pfor"
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                writer, encoder = writer or Writer(path), encoder or encoder_of(tokenizer)
                ids, counts = encoder.ids(part.column("text"))
                writer.add(ids, part.column("doc_id"), counts)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int64()), pa.array([path]),
                                              pa.array([writer.total], pa.int64())], names=["part", "path", "n_ids"])
    return write


def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            file = Reader(path)
            stop = np.cumsum(file.counts)
            low = 0
            while low < len(stop):  # some documents at once, or one long one
                before = int(stop[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(stop, before + READ_BLOCKS * BLOCK, side="right")))
                ids = file.ids(before, int(stop[high - 1])).astype("<u4")
                edges = np.append(0, stop[low:high] - before)
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(file.doc_id[low:high], mask=~file.known[low:high]),
                    pa.array(base + before + edges[:-1]), pa.array(file.counts[low:high]),
                    pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                low = high


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the ids of every text; one row for each file in the order of the documents."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/token-ids-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", "tie"]
    dealt = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards(docs, FILE_DOCS), *order)
             .sortWithinPartitions(*order).select("doc_id", "text"))
    return stored(dealt.mapInArrow(file_writer(folder, tokenizer), FILES))


def read_token_files(files: DataFrame) -> DataFrame:
    """One row for each document of the files: its place among all ids, their number and checksum."""
    placed = files.withColumn("start", F.sum("n_ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    placed = placed.select("part", "path", F.coalesce("start", F.lit(0)).alias("start"))
    return placed.repartition(max(1, files.count()), "part").mapInArrow(read_files, DOCS)
