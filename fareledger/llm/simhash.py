"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two that differ in at most four bits differ in at most four
bytes, so they share four positional bytes or more. The index posts every distinct fingerprint under
tuples of positional bytes; the position sets are chosen so that any four shared positions contain
one of them, hence every linked pair meets in some posting list. Within a list the shared positional
bytes of each pair are tallied, pairs under the guaranteed minimum go, the rest is verified bit by bit.

The tuples are as wide as keeps a list of evenly spread fingerprints at ``LIST`` members or fewer, so
the work a row stays bounded as the corpus grows; the width changes no result. Lists are streamed in
key order, one at a time. A list of near copies may still be long: beyond ``BLOCK`` members it is
dealt to one unit for each two of its blocks. Each unit returns a forest that joins what it links,
not the pairs, and the components of all forests are those of all links.

Defined results: null, empty and blank texts have fingerprint zero, linked like any other; a text of
one to three words is one shingle of all its words; repeated rows each give a row; a component is
named after its least non-null doc_id (null where it has none); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.llm.common import record, stored
from fareledger.llm.components import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
POSITIONS = 8    # bytes of a fingerprint
LIST = 64        # mean members of a posting list that the width of its key aims at
BLOCK = 4096     # members of a posting list compared in one unit
SHORT = 32       # members of a list whose pairs are compared by shifting the whole batch
STEP = 1 << 16   # shingles whose bits are counted at once
PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of every run of ``shingle`` words, repeats included; bytes are split at ASCII blanks."""
    words = text.lower().split()  # of bytes: only A-Z change
    if not words:
        return []
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    runs = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[:runs].tolist(), last.tolist())]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is 1 where over half of the shingles' hashes have it."""
    hashes = np.array(shingle_hashes(text, shingle), dtype="<u8")
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), STEP):
        part = hashes[low:low + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprinter(shingle: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py() or b"", shingle) for t in texts], np.uint64)
            yield record(PRINTS, doc_id=batch.column("doc_id"), fp=found.view(np.int64))
    return prints


@lru_cache
def position_sets(width: int, matches: int) -> tuple[tuple[int, ...], ...]:
    """Sets of ``width`` byte positions such that any ``matches`` positions contain one of them."""
    left = set(map(frozenset, combinations(range(POSITIONS), matches)))
    sets = [frozenset(s) for s in combinations(range(POSITIONS), width)]
    family = []
    while left:  # the set that settles most of what is left; the first of equals
        family.append(max(sets, key=lambda one: sum(one <= shared for shared in left)))
        left = {shared for shared in left if not family[-1] <= shared}
    return tuple(tuple(sorted(one)) for one in family)


def key_width(n: int, matches: int) -> int:
    """Bytes in a posting key for ``n`` distinct fingerprints."""
    width = min(2, matches)
    while width < min(4, matches) and n > LIST * 256**width:
        width += 1
    return width


def posting_keys(fp: Column, width: int, matches: int) -> Column:
    """The keys under which a fingerprint is posted: the number of the position set, then its bytes."""
    def key(number: int, positions: tuple[int, ...]) -> Column:
        value = F.lit(number << 32).cast("long")
        for place, position in enumerate(positions):
            byte = F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))
            value = value + F.shiftleft(byte, 8 * place)
        return value
    return F.array(*[key(i, p) for i, p in enumerate(position_sets(width, matches))])


def linked(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Where two aligned arrays of fingerprints link: count filter first, then the bits."""
    differ = np.bitwise_xor(a, b)
    tally = (differ.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
    some = np.flatnonzero(tally >= POSITIONS - distance)
    return some[np.bitwise_count(differ[some]) <= distance]


def forest(members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links within one list.

    Each member is compared with those not reached yet, so a list of near copies takes about one
    pass and only a list without links takes all pairs.
    """
    edges_a, edges_b, left = [], [], members
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            one = reached.pop()
            hit = linked(np.full(len(left), one), left, distance)
            if len(hit):
                edges_a.append(np.full(len(hit), one))
                edges_b.append(left[hit])
                reached.extend(left[hit])
                left = np.delete(left, hit)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *edges_a]), np.concatenate([none, *edges_b])


def link_lists(unit: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges within whole posting lists, given in the order of ``unit``."""
    first = np.concatenate([[0], np.flatnonzero(np.diff(unit)) + 1, [len(unit)]])
    size = np.repeat(np.diff(first), np.diff(first))
    out_a, out_b = [], []
    short = size <= SHORT
    for shift in range(1, int(size[short].max(initial=1))):
        at = np.flatnonzero(short[:-shift] & (unit[:-shift] == unit[shift:]))
        hit = at[linked(fp[at], fp[at + shift], distance)]
        out_a.append(fp[hit])
        out_b.append(fp[hit + shift])
    for low, high in zip(first[:-1], first[1:]):
        if high - low > SHORT:
            a, b = forest(fp[low:high], distance)
            out_a.append(a)
            out_b.append(b)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def linker(distance: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            unit = np.concatenate([unit, batch.column("unit").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0  # the last list may go on
            if whole:
                a, b = link_lists(unit[:whole], fp[:whole], distance)
                yield record(EDGES, a=a.view(np.int64), b=b.view(np.int64))
                unit, fp = unit[whole:], fp[whole:]
        if len(unit):
            a, b = link_lists(unit, fp, distance)
            yield record(EDGES, a=a.view(np.int64), b=b.view(np.int64))
    return link


def posting_units(prints: DataFrame, width: int, matches: int, block: int = BLOCK) -> DataFrame:
    """(unit, fp): the posting lists, a long one dealt to a unit for each two of its blocks."""
    posted = prints.select("fp", F.explode(posting_keys(F.col("fp"), width, matches)).alias("key"))
    long_lists = stored(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select(
        "key", (F.floor(F.col("n") / block) + 1).alias("blocks")))
    own = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks"))
    dealt = posted.join(long_lists, "key", "left")
    alone = dealt.where("blocks is null").select(F.col("key").alias("unit"), "fp")
    pairs = (dealt.where("blocks is not null").withColumn("own", own)
             .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).where("own <> other")
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "fp"))
    return alone.unionByName(pairs)


def links(prints: DataFrame, distance: int = DISTANCE, width: int | None = None, block: int = BLOCK) -> DataFrame:
    """(a, b): edges that join all linked fingerprints of ``prints`` (fp, distinct)."""
    matches = POSITIONS - distance
    width = width or key_width(prints.count(), matches)
    units = posting_units(prints, width, matches, block)
    parts = max(1, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    streamed = units.repartition(parts, "unit").sortWithinPartitions("unit")
    return streamed.mapInArrow(linker(distance), "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                       width: int | None = None, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, n_same.

    ``n_same`` is the number of documents with that very fingerprint. ``distance`` may be 0 to 6.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = stored(rows.mapInArrow(fingerprinter(shingle), "doc_id long, fp long"))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_same")))
    found = components(links(nodes.select("fp"), distance, width, block))
    rooted = (nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = rooted.join(named, "root").select("fp", "component_id", "n_same")
    return prints.join(facts, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_same")
