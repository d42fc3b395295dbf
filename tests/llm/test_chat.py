import itertools

import numpy as np
from pyspark.sql import functions as F

from fareledger.llm import chat
from fareledger.llm.common import table
from fareledger.llm.toxicity import held_out


def model(seed):
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.integers(0, 20, shape).astype(float)
    return chat.Model(draw(chat.STATES), draw(chat.STATES, chat.STATES), [draw(chat.STATES, n) for n in chat.FEATURES])


def test_viterbi_is_the_best_of_all_paths():
    for seed in range(4):
        m, rng = model(seed), np.random.default_rng(seed)
        features = np.column_stack([rng.integers(0, n, 5) for n in chat.FEATURES])
        emit = m.scores(features)

        def score(path):
            return m.start[path[0]] + emit[0, path[0]] + sum(
                m.move[a, b] + emit[k + 1, b] for k, (a, b) in enumerate(zip(path, path[1:])))
        best = max(itertools.product(range(chat.STATES), repeat=5), key=score)
        assert abs(score(tuple(chat.viterbi(m, features))) - score(best)) < 1e-9


def turns_of(spark):
    return chat.raw_transcripts(table(spark, "/root/testdata/sf0.01", "conversations"))


def roles(spark, lines, m):
    rows = chat.recover(lines.drop("role"), m)
    return {(r.conv_id, r.turn, r.line): r.role for r in rows.collect()}


def test_blocks_give_the_path_of_the_whole(spark, monkeypatch):
    turns = turns_of(spark).where("conv_id < 25")
    lines = chat.lines_of(turns, F.col("text"))
    m = chat.fit(lines)
    m.emit[-1][:] = 0  # what is seen within a block only
    whole = roles(spark, lines, m)
    monkeypatch.setattr(chat, "BLOCK_TURNS", 2)
    assert roles(spark, lines, m) == whole


def test_held_out_roles_are_recovered(spark):
    lines = chat.lines_of(turns_of(spark), F.col("text"))
    m = chat.fit(lines.where(~held_out(F.col("conv_id"), 5)))
    truth = {(r.conv_id, r.turn, r.line): chat.ROLES.index(r.role) for r in lines.where(held_out(F.col("conv_id"), 5)).collect()}
    found = roles(spark, lines, m)
    assert np.mean([found[k] == v for k, v in truth.items()]) > 0.95


def test_canonical_turns(spark):
    turns = spark.createDataFrame([(1, 0, "User: Hi there\nmore\n"), (1, 1, "Assistant: Yes.\n"), (1, 2, "> Q: And now?\n")],
                                  "conv_id long, turn long, text string")
    out = chat.format_chats(turns, turns_of(spark)).orderBy("turn_no").collect()
    assert [r.role for r in out] == ["user", "assistant", "user"]
    assert out[0].rendered == "<|user|>\nHi there\nmore\n<|end|>\n"
    assert out[1].rendered == "<|assistant|>\nYes.\n<|end|>\n"


def test_awkward_rows(spark):
    rows = [(1, None, "user", None), (1, 0, None, "User: a"), (1, 0, None, "User: a"), (None, 2, "user", "x\n" * 3000),
            (2, 5, "assistant", ""), (None, None, None, None), (3, 1, "user", "y" * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("b"))
    out = chat.format_chats(turns, turns).collect()
    assert {r.conv_id for r in out} == {1, 2, 3, None}
    lines = sum((t or "").count("\n") + 1 for *_, t in rows)
    assert sum(r.n_lines for r in out) == lines
    assert chat.format_chats(turns.limit(0), turns).count() == 0
    assert chat.format_chats(turns, turns.limit(0)).count() > 0
