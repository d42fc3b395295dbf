"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A line is in one of six states: a turn of one of three roles begins with it or goes on. Emissions
are its speaker marker and line features, independent given the state; all tables are counted from
transcripts whose roles are known and smoothed by one. The most likely path is found by Viterbi in
three steps, so that a conversation of any length is spread over tasks: each block of lines is
summed up as the best score between any two states at its ends, the path is first decided at the
ends of blocks, and then inside each block between its given ends.

Defined results: a null line is an empty one and a null turn comes first; repeated rows are lines
of their own, ordered by their text; a null conversation is one conversation; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareledger.llm.common import stored

ROLES = ["system", "user", "assistant"]
STATES = 2 * len(ROLES)  # role, then whether the turn goes on: 2 * role + goes_on
BLOCK_TURNS = 256
# Speaker markers by role.
MARKERS = {
    "system": ["system", "instructions", "context"],
    "user": ["user", "human", "q", "question", "customer"],
    "assistant": ["assistant", "ai", "bot", "a", "answer", "agent"],
}
MARK = r"^\s*(?:#+\s*|\*\*|\[|<\|?)?(" + "|".join(x for names in MARKERS.values() for x in names) + r")(?:\*\*|\]|\|?>)?\s*[:>]\s*"
_NUMBER = {name: i + 1 for i, names in enumerate(MARKERS.values()) for name in names}
#: Values of each feature: marker's role, blank, ends as a question, length class, first letter; the
#: last, whether the line before is blank, is seen within a block.
FEATURES = [4, 2, 2, 4, 3, 2]


def lines_of(turns: DataFrame, text: Column) -> DataFrame:
    """One row for each line: conv_id, turn, line, text, and its features but the first line's."""
    rows = turns.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                        *(["role"] if "role" in turns.columns else []),
                        F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("line", "text"))
    mark = F.lower(F.regexp_extract("text", "(?i)" + MARK, 1))
    number = F.coalesce(*[F.when(mark == name, F.lit(i)) for name, i in _NUMBER.items()], F.lit(0))
    first = F.substring(F.ltrim("text"), 1, 1)
    return rows.withColumn("features", F.array(
        number, (F.trim("text") == "").cast("int"), F.col("text").rlike(r"\?\s*$").cast("int"),
        F.when(F.length("text") < 1, 0).when(F.length("text") < 40, 1).when(F.length("text") < 200, 2).otherwise(3),
        F.when(first == "", 0).when(first == F.upper(first), 1).otherwise(2)))


def block_of() -> Column:
    return F.floor(F.col("turn") / BLOCK_TURNS)


class Model:
    """Log probabilities of starts, transitions and emissions."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]) -> None:
        norm = lambda x: np.log((x + 1) / (x + 1).sum(axis=-1, keepdims=True))
        self.start, self.move, self.emit = norm(start), norm(move), [norm(e) for e in emit]

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Emission score of each line in each state."""
        return sum(e[:, features[:, k]].T for k, e in enumerate(self.emit))


def fit(lines: DataFrame) -> Model:
    """Count a model from lines with known ``role``; transitions are counted within blocks."""
    role = F.coalesce(*[F.when(F.col("role") == r, F.lit(i)) for i, r in enumerate(ROLES)])
    state = lines.select("conv_id", "turn", "line", "text", "features", (2 * role + (F.col("line") > 0).cast("int")).alias("state"))
    order = Window.partitionBy("conv_id", block_of()).orderBy("turn", "line", "text")
    pairs = state.where("state is not null").select(
        "state", "features", F.lag("state").over(order).alias("before"),
        F.coalesce(F.lag(F.col("features")[1]).over(order), F.lit(0)).alias("gap"))
    shape = F.concat_ws(",", "features", "gap")
    counts = pairs.groupBy(F.coalesce("before", F.lit(-1)).alias("before"), "state", shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    start, move = np.zeros(STATES), np.zeros((STATES, STATES))
    emit = [np.zeros((STATES, n)) for n in FEATURES]
    for before, now, values, n in counts:
        if before < 0:
            start[now] += n
        else:
            move[before, now] += n
        for table, value in zip(emit, values.split(",")):
            table[now, int(value)] += n
    return Model(start, move, emit)


def ordered(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    table = pa.Table.from_batches(list(batches)).combine_chunks()
    return table.sort_by([("turn", "ascending"), ("line", "ascending"), ("text", "ascending")])


def features_of(table: pa.Table) -> np.ndarray:
    own = table["features"].combine_chunks().flatten().to_numpy().reshape(len(table), len(FEATURES) - 1)
    return np.column_stack([own, np.append(0, own[:-1, 1])])


def block_scores(model: Model):
    """Best score of each block from any state before it to any state at its end."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ordered(batches)
        emit = model.scores(features_of(table))
        best = model.move + emit[0]
        begin = model.start + emit[0]
        both = np.vstack([best, begin])  # the last row: nothing stands before the block
        for row in emit[1:]:
            both = (both[:, :, None] + model.move[None]).max(axis=1) + row
        yield pa.RecordBatch.from_arrays([table["conv_id"].combine_chunks()[:1], table["block"].combine_chunks()[:1],
                                          pa.array([both.ravel().tolist()], pa.list_(pa.float64()))],
                                         names=["conv_id", "block", "best"])
    return score


def block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States at the ends of a conversation's blocks on its most likely path."""
    table = pa.Table.from_batches(list(batches)).combine_chunks().sort_by("block")
    best = np.array(table["best"].to_pylist()).reshape(len(table), STATES + 1, STATES)
    score, back = best[0, STATES], []
    for block in best[1:]:
        through = score[:, None] + block[:STATES]
        back.append(through.argmax(axis=0))
        score = through.max(axis=0)
    ends = [int(score.argmax())]
    for choice in reversed(back):
        ends.append(int(choice[ends[-1]]))
    ends = ends[::-1]
    yield pa.RecordBatch.from_arrays([table["conv_id"].combine_chunks(), table["block"].combine_chunks(),
                                      pa.array([-1, *ends[:-1]], pa.int32()), pa.array(ends, pa.int32())],
                                     names=["conv_id", "block", "before", "after"])


def viterbi(model: Model, features: np.ndarray, before: int = -1, after: int | None = None) -> np.ndarray:
    """Most likely states of the lines, with the states before and at the end given if known."""
    emit = model.scores(features)
    score = (model.start if before < 0 else model.move[before]) + emit[0]
    back = []
    for row in emit[1:]:
        through = score[:, None] + model.move
        back.append(through.argmax(axis=0))
        score = through.max(axis=0) + row
    path = [int(score.argmax()) if after is None else after]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return np.array(path[::-1])


def decoder(model: Model):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ordered(batches)
        path = viterbi(model, features_of(table), table["before"][0].as_py(), table["after"][0].as_py())
        begins = np.append(table["before"][0].as_py() < 0, path[1:] // 2 != path[:-1] // 2) if len(path) else path
        begins = begins | (path % 2 == 0)
        if table["before"][0].as_py() >= 0:
            begins[0] |= path[0] // 2 != table["before"][0].as_py() // 2
        yield pa.RecordBatch.from_arrays([
            *(table[c].combine_chunks() for c in ("conv_id", "block", "turn", "line", "text")),
            pa.array(path // 2, pa.int32()), pa.array(np.cumsum(begins))],
            names=["conv_id", "block", "turn", "line", "text", "role", "own"])
    return decode


def recover(lines: DataFrame, model: Model) -> DataFrame:
    """Lines with their recovered role and the number of the recovered turn they belong to."""
    id_type = lines.schema["conv_id"].dataType.simpleString()
    rows = stored(lines.select("conv_id", "turn", "line", "text", "features", block_of().alias("block")))
    scored = rows.groupBy("conv_id", "block").applyInArrow(block_scores(model), f"conv_id {id_type}, block long, best array<double>")
    ends = scored.groupBy("conv_id").applyInArrow(block_ends, f"conv_id {id_type}, block long, before int, after int")
    same = rows["conv_id"].eqNullSafe(ends["conv_id"]) & (rows["block"] == ends["block"])
    joined = rows.join(ends, same).select(rows["*"], "before", "after")
    decoded = stored(joined.groupBy("conv_id", "block").applyInArrow(
        decoder(model), f"conv_id {id_type}, block long, turn long, line int, text string, role int, own long"))
    sizes = decoded.groupBy("conv_id", "block").agg(F.max("own").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return (decoded.join(offsets, decoded["conv_id"].eqNullSafe(F.col("c")) & (decoded["block"] == F.col("b")))
            .withColumn("turn_no", F.col("earlier") + F.col("own") - 1).drop("c", "b", "earlier", "own"))


def canonical_turns(recovered: DataFrame) -> DataFrame:
    """One row for each recovered turn: role, lines, and its text in canonical form.

    Markers go from the first line, blank lines at both ends too.
    """
    name = F.element_at(F.array(*map(F.lit, ROLES)), F.col("role") + 1)
    lines = F.sort_array(F.collect_list(F.struct("turn", "line", "text")))
    turns = recovered.groupBy("conv_id", "turn_no").agg(
        F.max(name).alias("role"), F.count(F.lit(1)).alias("n_lines"), lines.alias("lines"))
    body = F.regexp_replace(F.array_join(F.col("lines.text"), "\n"), "(?i)" + MARK, "")
    body = F.regexp_replace(body, r"^\s+|\s+$", "")
    return turns.select("conv_id", "turn_no", "role", "n_lines", F.concat(
        F.lit("<|"), F.col("role"), F.lit("|>\n"), body, F.lit("\n<|end|>\n")).alias("rendered"))


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """Turns as people paste them: a marker style by conversation, and turns without a marker.

    A fourth of the turns has no marker; these and all of some conversations follow a blank line.
    """
    style = F.pmod(F.xxhash64(F.lit("style"), "conv_id"), F.lit(3))
    names = [["System", "User", "Assistant"], ["Instructions", "Human", "AI"], ["Context", "Q", "A"]]
    marks = [F.coalesce(*[F.when(F.col("role") == r, F.lit(f"{n}: ")) for r, n in zip(ROLES, own)], F.lit(""))
             for own in names]
    mark = F.when(style == 0, marks[0]).when(style == 1, marks[1]).otherwise(marks[2])
    bare = F.pmod(F.xxhash64(F.lit("bare"), "conv_id", "turn"), F.lit(4)) == 0
    return turns.withColumn("text", F.concat(F.when(bare, "").otherwise(mark), F.coalesce("text", F.lit("")), F.lit("\n")))


def format_chats(turns: DataFrame, known: DataFrame) -> DataFrame:
    """Canonical turns of transcripts whose roles are unknown; ``known`` ones have a ``role``."""
    model = fit(lines_of(known, F.col("text")))
    return canonical_turns(recover(lines_of(turns.drop("role"), F.col("text")), model))
