"""Hard-negative mining with rotated one-bit codes and deterministic interval filters.

Every row's vector x is turned by ``STACK`` fixed rotations and only the signs are kept: s = sign(Rx).
Beside the code the index stores the alignment of x with the code's vector c = R's/|R's|, a = <x, c>,
and the length of what is left, r = |x - a c|. For a query q, <c, q> follows from popcounts of the code
with the bit planes of the quantised Rq, up to a known quantisation error. The rest obeys
|<x - a c, q>| <= r * sqrt(|q|^2 - <c, q>^2) (Cauchy-Schwarz), so every score lies in an interval that is
certain, not likely. Rows whose interval cannot reach what is asked for are dropped; the others are
scored as integers. The filter decides how much is scored, never what is returned.

All usable rows are indexed, in blocks; the anchors' index is written once to the shared folder, and a
task reads it piece by piece against each of its blocks. So a task holds one block and one piece, rows
are never shuffled to meet anchors, and only the best few of each block and anchor leave the task. A
first pass finds each anchor's positives, a second the negatives within their score windows.

Defined results: scores are sums of longs (exact while they fit in one). Rows with a null label, a null vector or a
null or non-finite component take no part, nor do vectors of another length than the commonest (empty
ones among them). Rows that repeat a vec_id are rows of their own: each is a possible positive or
negative, and each is an anchor if its id is divisible by 50. A null vec_id is no anchor and comes last
in ties. An anchor without positives, or a positive without negatives in its window, gives no row; an
empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareledger.llm.common import shards, stored
from fareledger.llm.vectors import matrix, usable
from fareledger.session import shared_dir

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LOW, HIGH = 50, 95   # percent of the positive's score between which a negative lies
STACK, PLANES = 8, 6  # code bits for each dimension; bits of a quantised query
BLOCK = 1 << 15      # rows of the index searched at once
PIECE = 512          # anchors read at once
PAIRS = 1 << 19      # estimates held at once
ANCHOR_FILE = 1 << 16
LAST = np.iinfo(np.int64).max  # where a null id comes in ties


@lru_cache
def rotations(dim: int, stack: int = STACK) -> np.ndarray:
    """``stack`` fixed random rotations, one below the other."""
    rng = np.random.default_rng(1201)
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(stack)])


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, padded with zeros."""
    rows, n = bits.shape
    wide = np.zeros((rows, -(-n // 64) * 64), bool)
    wide[:, :n] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the rows of ``x``, their alignment, the length of R's, and the length of the rest."""
    r = rotations(x.shape[1])
    values = x.astype(np.float64)
    bits = values @ r.T > 0
    vector = np.where(bits, 1.0, -1.0) @ r
    length = np.linalg.norm(vector, axis=1)
    length[length == 0] = 1.0
    align = np.einsum("ij,ij->i", values, vector) / length
    rest = np.sqrt(np.maximum(np.einsum("ij,ij->i", values, values) - align**2, 0))
    return packed(bits), align, length, rest


INDEX = "row long, vec_id long, label int, x array<long>, code binary, align double, length double, rest double"


def indexer(dim: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code, align, length, rest = encode(matrix(batch.column("x"), dim))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "vec_id", "label", "x")),
                     pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array(align), pa.array(length), pa.array(rest)],
                    names=["row", "vec_id", "label", "x", "code", "align", "length", "rest"])
    return index


class Index:
    """Rows of the index as arrays."""

    def __init__(self, table: pa.Table, dim: int) -> None:
        table = table.combine_chunks()
        self.row = table.column("row").to_numpy()
        self.vec_id = table.column("vec_id").fill_null(LAST).to_numpy()
        self.label = table.column("label").to_numpy()
        self.x = matrix(table.column("x").chunk(0), dim) if len(table) else np.zeros((0, dim), np.int64)
        words = -(-STACK * dim // 64)
        self.code = np.frombuffer(b"".join(table.column("code").to_pylist()), "<u8").reshape(-1, words)
        self.align, self.length, self.rest = (table.column(c).to_numpy() for c in ("align", "length", "rest"))
        self.ones = np.bitwise_count(self.code).sum(axis=1, dtype=np.int64)
        # Sums of products stay exact in float64 below 2^53.
        self.top = np.abs(self.x.astype(np.float64)).max(initial=0)

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Integer inner products of the rows ``at`` with the query."""
        if self.top * np.abs(query.astype(np.float64)).max(initial=0) * len(query) < 2**53:
            return (self.x[at].astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        return (self.x[at] * query).sum(axis=1)


def intervals(index: Index, queries: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Certain bounds of <query, row>, one line a query, for the rows ``at`` of the index."""
    turned = queries.astype(np.float64) @ rotations(queries.shape[1]).T
    low = turned.min(axis=1, keepdims=True)
    step = (turned.max(axis=1, keepdims=True) - low) / (2**PLANES - 1)
    level = np.rint((turned - low) / np.where(step > 0, step, 1)).astype(np.int64)
    quantised = low + step * level
    error = np.abs(turned - quantised).sum(axis=1, keepdims=True)
    code, total = index.code[at], np.zeros((len(queries), len(at)))
    for plane in range(PLANES):
        words = packed(level >> plane & 1 == 1)
        shared = np.zeros((len(queries), len(at)), np.uint16)
        for k in range(code.shape[1]):
            shared += np.bitwise_count(words[:, k, None] & code[None, :, k])
        total += shared * float(1 << plane)
    signed = 2 * (low * index.ones[at] + step * total) - quantised.sum(axis=1, keepdims=True)
    along, error = signed / index.length[at], error / index.length[at]
    square = np.einsum("ij,ij->i", queries, queries, dtype=np.float64)[:, None]
    side = np.sqrt(np.maximum(square - np.maximum(np.abs(along) - error, 0)**2, 0))
    align, rest = index.align[at], index.rest[at]
    # Rounding of the sums above, far below one unit of a score.
    slack = 1e-9 * np.sqrt(square) * (np.abs(align) + rest) + 1e-6
    half = np.abs(align) * error + rest * side + slack
    return align * along - half, align * along + half


def kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity where there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def first(score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first by falling score, ties by smaller id."""
    return np.lexsort((vec_id, -score))[:k]


def pieces(folder: str, columns: list[str]) -> Iterator[pa.Table]:
    """The stored anchors, ``PIECE`` at a time."""
    files, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)
    for info in sorted(files.get_file_info(fs.FileSelector(path)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with files.open_input_file(info.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(PIECE, columns=columns):
                    yield pa.Table.from_batches([batch])


def blocks(batches: Iterator[pa.RecordBatch], dim: int, rows: int = BLOCK) -> Iterator[Index]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield Index(pa.Table.from_batches(held), dim)
            held, n = [], 0
    if n:
        yield Index(pa.Table.from_batches(held), dim)


POSITIVE = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("row", pa.int64()),
                      ("positive_id", pa.int64()), ("positive_score", pa.int64())])


def positive_finder(folder: str, dim: int, count: int):
    """The first ``count`` rows of the anchor's label in each block of the index."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in blocks(batches, dim):
            of_label = {label: np.flatnonzero(index.label == label) for label in np.unique(index.label)}
            for piece in pieces(folder, ["row", "vec_id", "label", "x"]):
                row, vec_id, label = (piece.column(c).to_numpy() for c in ("row", "vec_id", "label"))
                x = matrix(piece.combine_chunks().column("x").chunk(0), dim)
                out = []
                for one in np.intersect1d(label, list(of_label)):
                    at, mine = of_label[one], np.flatnonzero(label == one)
                    step = max(1, PAIRS // len(at))
                    for low in range(0, len(mine), step):
                        few = mine[low:low + step]
                        least, most = intervals(index, x[few], at)
                        other = index.row[at][None, :] != row[few][:, None]
                        for k, anchor in enumerate(few):
                            bar = kth(least[k][other[k]], count)
                            near = at[other[k] & (most[k] >= bar)]
                            score = index.scores(near, x[anchor])
                            best = first(score, index.vec_id[near], count)
                            out.append((np.full(len(best), row[anchor]), np.full(len(best), vec_id[anchor]),
                                        index.row[near[best]], index.vec_id[near[best]], score[best]))
                if out:
                    yield batch_of(POSITIVE, out)
    return find


NEGATIVE = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("row", pa.int64()),
                      ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def negative_finder(folder: str, dim: int, count: int):
    """The first ``count`` rows of other labels in each positive's window, in each block of the index."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in blocks(batches, dim):
            everyone = np.arange(len(index.row))
            step = max(1, PAIRS // len(everyone))
            for piece in pieces(folder, ["row", "label", "x", "scores"]):
                row, label = piece.column("row").to_numpy(), piece.column("label").to_numpy()
                x = matrix(piece.combine_chunks().column("x").chunk(0), dim)
                asked = piece.column("scores").to_pylist()
                out = []
                for low in range(0, len(row), step):
                    few = np.arange(low, min(low + step, len(row)))
                    least, most = intervals(index, x[few], everyone)
                    for k, anchor in enumerate(few):
                        other = index.label != label[anchor]
                        windows = [(-(-LOW * p // 100), HIGH * p // 100) for p in asked[anchor]]
                        near = np.zeros(len(other), bool)
                        for floor, ceiling in windows:
                            inside = other & (least[k] >= floor) & (most[k] <= ceiling)
                            bar = max(floor, kth(least[k][inside], count))
                            near |= other & (most[k] >= bar) & (least[k] <= ceiling)
                        near = np.flatnonzero(near)
                        score = index.scores(near, x[anchor])
                        for place, (floor, ceiling) in enumerate(windows):
                            fit = np.flatnonzero((score >= floor) & (score <= ceiling))
                            best = fit[first(score[fit], index.vec_id[near[fit]], count)]
                            out.append((np.full(len(best), row[anchor]), np.full(len(best), place, np.int32),
                                        index.row[near[best]], index.vec_id[near[best]], score[best]))
                if out:
                    yield batch_of(NEGATIVE, out)
    return find


def batch_of(schema: pa.Schema, parts: list[tuple]) -> pa.RecordBatch:
    """One batch of many parts of its columns; the id that stands for null is null again."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type, mask=(c == LAST) if f.name.endswith("_id") else None)
         for c, f in zip(columns, schema)], schema=schema)


def written(df: DataFrame) -> str:
    """The folder of the shared place that ``df`` is written to."""
    path = f"{shared_dir(df.sparkSession)}/anchors-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def ranked(df: DataFrame, keys: list[str], score: str, vec_id: str, count: int, name: str) -> DataFrame:
    """The first ``count`` of each key; a task keeps its own first before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(vec_id), "row")
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= count)


def labelled(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """Usable rows with a label; every seventh id has its label moved on by one."""
    rows, dim = usable(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                                         F.col("label").cast("int").alias("label"), "embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return rows.where("label is not null").select("vec_id", moved.alias("label"), "x"), dim


def hard_negatives(rows: DataFrame, dim: int, every: int = EVERY, positives: int = POSITIVES,
                   negatives: int = NEGATIVES) -> DataFrame:
    """One row per anchor, positive and returned negative of ``rows`` (vec_id, label, x)."""
    numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    index = stored(numbered.mapInArrow(indexer(dim), INDEX))
    anchors = stored(index.where(F.col("vec_id") % every == 0).select("row", "vec_id", "label", "x"))
    folder = written(anchors.repartition(shards(anchors, ANCHOR_FILE)))
    near = index.mapInArrow(positive_finder(folder, dim, positives), (
        "anchor long, anchor_id long, row long, positive_id long, positive_score long"))
    pairs = stored(ranked(near, ["anchor"], "positive_score", "positive_id", positives, "nth"))
    wanted = pairs.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))),
                    lambda p: p["positive_score"]).alias("scores"))
    asking = anchors.join(wanted, anchors["row"] == wanted["anchor"]).select("row", "label", "x", "scores")
    windows = written(asking.repartition(shards(anchors, ANCHOR_FILE)))
    found = index.mapInArrow(negative_finder(windows, dim, negatives), (
        "anchor long, place int, row long, negative_id long, negative_score long"))
    best = ranked(found, ["anchor", "place"], "negative_score", "negative_id", negatives, "rank")
    place = pairs.withColumn("place", F.col("nth") - 1).drop("row", "nth")
    return best.drop("row").join(place, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score")


def mine(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """Hard negatives of an embeddings table (vec_id, embedding, label)."""
    return hard_negatives(*labelled(embeddings))


SQL = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as x
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), vectors as (select *, row_number() over () as row from usable),
scored as (
  select a.row as anchor, a.vec_id as anchor_id, b.row, b.vec_id, a.label = b.label as same,
    list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::bigint as score
  from vectors a join vectors b on a.vec_id % 50 = 0 and a.row <> b.row
), positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor order by score desc, vec_id nulls last, row) <= 5
), ranked as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id,
    p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor, p.row order by n.score desc, n.vec_id nulls last, n.row) as rank
  from positives p join scored n on p.anchor = n.anchor and not n.same
    and 100 * n.score between 50 * p.score and 95 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from ranked where rank <= 3
"""
