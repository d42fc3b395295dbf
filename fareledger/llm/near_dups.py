"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

Texts become sets of runs of five words. Equal sets are one node. A node has one label in each of
``trees`` prefix trees, a string of ``DEPTH`` MinHash values, and the labels of all nodes lie sorted
by tree and label, so that a prefix is a range of neighbours. Each node starts with whole labels and
shortens its prefixes level by level until the estimated recall reaches the target: the chance that
the least similar partner which a set of its size can have shares the prefix in some tree. Sets of
up to three runs have no partner at 0.8 but their equals and take no part; small sets stop at long
prefixes; large ones at the 5 values that 0.8 itself asks for. Two nodes meet where their common
prefix is as long as the longer of their two, which is enough for either. A range that two partitions
share is tied by a point named after its prefix, so a hot prefix may be split anywhere.
Nodes that meet anywhere are gathered in groups, and every
pair in a group is verified exactly: shared runs are counted by blocks of a sparse product, so
links are counted and classes are joined without a row for each pair. A group of more than
``block`` nodes is dealt to one task for each pair of its blocks.

Defined results: null, empty and blank texts have no runs, no links and a class of their own; a
text of one to four words is one run of all its words; rows with the same id and text are copies
of each other; a class is named after its least non-null doc_id (null where it has none); an
empty table gives an empty result; other columns pass through the filter untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareledger.llm import words as W
from fareledger.llm.common import record, row_key, slices, stored
from fareledger.llm.components import components

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9999
BLOCK = 512        # nodes compared at once
TASK_NODES = 2000  # nodes of small groups that share one task
SHARED = 4096      # runs of a product step
_RNG = np.random.default_rng(80)
_SCALE = _RNG.integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)


def recall_at(depth: int, trees: int, threshold: float) -> float:
    """Chance that a pair at the threshold shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - threshold**depth) ** trees


def least_similarity(size: int, threshold: float = THRESHOLD) -> float | None:
    """Least similarity at or over the threshold that a different set can have with one of ``size``."""
    if size * (1 - threshold) > 40:
        return threshold  # so many are possible that the least is next to it
    least = None
    for other in range(1, int(size / threshold + 1e-9) + 1):
        both = math.ceil(threshold * (size + other) / (1 + threshold) - 1e-9)
        if both <= min(size, other) and both < max(size, other):
            least = min(least or 1, both / (size + other - both))
    return least


@lru_cache(100_000)
def prefix_depth(size: int, threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES,
                 depth: int = DEPTH) -> int | None:
    """Where a set of ``size`` runs stops shortening its prefixes; None without possible partners."""
    similarity = least_similarity(size, threshold)
    if similarity is None:
        return None
    while depth > 1 and recall_at(depth, trees, similarity) < recall:
        depth -= 1
    return depth


def labels_of(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels of each text, tree by tree, two bytes a value; every text must have a run."""
    labels = np.zeros((len(first), TREES * DEPTH), ">u2")
    for k in range(TREES * DEPTH):
        least = np.minimum.reduceat(W.mix_fast(runs * _SCALE[k] + _SHIFT[k]), first)
        labels[:, k] = W.mix(least) >> np.uint64(48)
    return labels


SKETCH = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("node", pa.int64()), ("depth", pa.int32()),
                    ("labels", pa.binary())])


def sketcher(threshold: float, recall: float):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                runs, first = W.grams(W.split(part.column("text")), WORDS)
                some = np.flatnonzero(np.diff(first))
                node = np.zeros(len(part), np.int64)
                depth, labels = [None] * len(part), [None] * len(part)
                if len(some):
                    for i, label in zip(some, labels_of(runs, first[some])):
                        own = np.unique(runs[first[i]:first[i + 1]])
                        node[i] = W.mix(np.array([W.mix(own).sum() + np.uint64(len(own))])).view(np.int64)[0]
                        depth[i] = prefix_depth(len(own), threshold, recall)
                        labels[i] = None if depth[i] is None else label.tobytes()
                empty = np.ones(len(part), bool)
                empty[some] = False
                yield record(SKETCH, row=part.column("row"), doc_id=part.column("doc_id"),
                             node=pa.array(node, mask=empty), depth=depth, labels=labels)
    return sketch


MEETS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Level:
    """Ranges of one prefix length, met in sorted order: each node meets the first of its range."""

    def __init__(self, length: int) -> None:
        self.length, self.prefix, self.hub, self.hub_depth = length, None, 0, 0

    def point(self, prefix: np.ndarray) -> int:
        """The name of a range, for its parts in other partitions."""
        name = xxhash.xxh64_intdigest(bytes([self.length]) + prefix.tobytes())
        return int(np.uint64(name).astype(np.int64))

    def meet(self, keys: np.ndarray, node: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(depth <= self.length)
        if not len(at):
            return node[:0], node[:0]
        keys, node, depth = keys[at, :1 + 2 * self.length], node[at], depth[at]
        begins = self.prefix is None
        new = np.append(begins or (keys[0] != self.prefix).any(), (keys[1:] != keys[:-1]).any(axis=1))
        start = np.maximum.accumulate(np.where(new, np.arange(len(at)), -1))
        hub = np.where(start < 0, self.hub, node[start])
        hub_depth = np.where(start < 0, self.hub_depth, depth[start])
        # Nodes that stop further up have met at their own level.
        keep = ~new & ((depth == self.length) | (hub_depth == self.length)) & (hub != node)
        self.prefix, self.hub, self.hub_depth = keys[-1], hub[-1], hub_depth[-1]
        a, b = node[keep], hub[keep]
        return (np.append(a, node[0]), np.append(b, self.point(keys[0]))) if begins else (a, b)


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Who meets in a sorted stretch of the trees; the ranges at its two ends are tied to their points."""
    levels = [Level(length) for length in range(1, DEPTH + 1)]
    for batch in batches:
        if not batch.num_rows:
            continue
        node, depth, tree = (batch.column(n).to_numpy() for n in ("node", "depth", "tree"))
        label = np.frombuffer(b"".join(batch.column("label").to_pylist()), np.uint8).reshape(-1, 2 * DEPTH)
        keys = np.column_stack([tree.astype(np.uint8), label])
        for level in levels:
            a, b = level.meet(keys, node, depth)
            if len(a):
                yield record(MEETS, a=a, b=b)
    ends = [level for level in levels if level.prefix is not None]
    yield record(MEETS, a=[int(x.hub) for x in ends], b=[x.point(x.prefix) for x in ends])


SETS = pa.schema([("task", pa.int64()), ("unit", pa.int64()), ("side", pa.int32()), ("node", pa.int64()),
                  ("copies", pa.int64()), ("runs", pa.binary())])


def run_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted set of runs of each text, beside the columns that say where it goes."""
    names = ["comp", "blocks", "node", "copies"]
    for batch in batches:
        for part in slices(batch):
            runs, first = W.grams(W.split(part.column("text")), WORDS)
            sets = [np.unique(runs[a:b]).tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(sets, pa.binary())],
                                             names=[*names, "runs"])


FOUND = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def shared_runs(sets: list[np.ndarray]) -> np.ndarray:
    """Number of runs that each two of the sets share."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    keep = count[inverse] > 1
    column, owner = number[inverse[keep]], owner[keep]
    out = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    top = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, top, SHARED):
        a, b = np.searchsorted(column, [low, low + SHARED])
        x = np.zeros((m, min(SHARED, top - low)), np.float32)
        x[owner[a:b], column[a:b] - low] = 1
        out += x @ x.T
    return out


def linked(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold; with two sides only pairs across them."""
    size = np.array([len(s) for s in sets], np.float32)
    both = shared_runs(sets)
    links = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-6
    np.fill_diagonal(links, False)
    if side.min() != side.max():
        links &= side[:, None] != side[None, :]
    return links


def local_roots(links: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Least node that each node reaches."""
    root = node.copy()
    far = np.iinfo(np.int64).max
    while True:
        new = np.minimum(root, np.where(links, root[None, :], far).min(axis=1))
        if (new == root).all():
            return root
        root = new


def verifier(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        unit, side, node, copies = (table.column(n).to_numpy() for n in ("unit", "side", "node", "copies"))
        sets = table.column("runs")
        order = np.lexsort((side, node, unit))
        edges = np.flatnonzero(np.diff(unit[order])) + 1
        for own in np.split(order, edges):
            _, once = np.unique(node[own], return_index=True)  # rows that repeat an id and text
            own = own[once]
            if len(own) < 2:
                continue
            links = linked([np.frombuffer(sets[i].as_py(), np.uint64) for i in own], side[own], threshold)
            some = links.any(axis=1)
            if some.any():
                root = local_roots(links, node[own])
                yield record(FOUND, node=node[own][some], root=root[some],
                             links=(links @ copies[own])[some].astype(np.int64))
    return verify


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: row (its key), doc_id, class_id, class_row, n_copies, n_links.

    ``n_links`` counts the other documents whose sets reach the threshold, copies included.
    ``class_row`` is the key of the document that the class is named after.
    """
    rows = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    sketch = stored(rows.mapInArrow(sketcher(threshold, recall),
                                    "row long, doc_id long, node long, depth int, labels binary"))
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    nodes = stored(sketch.where("node is not null").groupBy("node").agg(
        F.min(name).alias("name"), F.count(F.lit(1)).alias("copies"), F.min("depth").alias("depth"),
        F.min("labels").alias("labels")))

    trees = nodes.where("labels is not null").select(
        "node", "depth", "labels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    trees = trees.select("tree", F.expr(f"substring(labels, tree * {2 * DEPTH} + 1, {2 * DEPTH})").alias("label"),
                         "node", "depth")
    meets = trees.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    meeting = components(meets.mapInArrow(forest, "a long, b long")).join(
        nodes.select("node", "name", "copies"), "node")  # without the points
    sizes = meeting.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = stored(meeting.join(sizes, "root").select(
        F.col("name.row").alias("row"), "node", "copies", F.col("root").alias("comp"),
        F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))

    tasks = max(1, groups.count() // TASK_NODES)
    # The groups grow with the corpus, so they are merged with the texts at every size.
    texts = rows.select("row", "text").join(groups.hint("merge"), "row")
    sets = texts.mapInArrow(run_sets, "comp long, blocks int, node long, copies long, runs binary")
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    # Small groups share tasks; a unit of a group of several blocks is a task, so it holds two blocks at most.
    task = F.when(F.col("blocks") > 1, F.col("unit")).otherwise(F.pmod("unit", F.lit(tasks)))
    dealt = (sets.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .withColumn("unit", F.xxhash64("comp", F.least("own", "other"), F.greatest("own", "other")))
             .select(task.alias("task"), "unit", F.col("own").cast("int").alias("side"), "node", "copies", "runs"))
    found = stored(dealt.groupBy("task").applyInArrow(verifier(threshold), "node long, root long, links long"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (classes.join(nodes.select("node", "name"), "node").groupBy("root").agg(F.min("name").alias("class")))
    classes = classes.join(named, "root").join(links, "node", "left").select("node", "class", "links")
    facts = nodes.select("node", "name", "copies").join(classes, "node", "left").select(
        "node", "copies", F.coalesce("class", "name").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    return sketch.select("row", "doc_id", "node").join(facts, "node", "left").select(
        "row", "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class.doc_id")).alias("class_id"),
        F.when(F.col("node").isNull(), F.col("row")).otherwise(F.col("class.row")).alias("class_row"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that their class is named after; texts without words all stay."""
    kept = jaccard_classes(docs, threshold).where("row = class_row").select("row").distinct()
    whole = docs.select(row_key().alias("row"), F.struct("*").alias("doc"))
    return whole.join(kept.hint("merge"), "row", "left_semi").dropDuplicates(["row"]).select("doc.*")
