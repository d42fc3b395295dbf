import numpy as np
import pytest

from fareledger.llm import hard_negatives as H
from fareledger.llm.common import table
from fareledger.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """The contract by comparing every two rows: (vec_id, embedding, label) tuples."""
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(c is None or not np.isfinite(c) for c in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, label, [int(np.floor(256 * float(np.float32(c)))) for c in vector]))

    def order(pair):
        score, i = pair
        return -score, kept[i][0] is None, kept[i][0] or 0
    out = []
    for a, (anchor, label, x) in enumerate(kept):
        if anchor is None or anchor % 50:
            continue
        scores = [sum(p * q for p, q in zip(x, other[2])) for other in kept]
        same = sorted(((scores[i], i) for i in range(len(kept)) if i != a and kept[i][1] == label), key=order)[:5]
        for score, i in same:
            fit = sorted(((s, j) for j, s in enumerate(scores)
                          if kept[j][1] != label and 50 * score <= 100 * s <= 95 * score), key=order)[:3]
            out += [(anchor, kept[i][0], rank, kept[j][0], score, s) for rank, (s, j) in enumerate(fit, 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
                   for r in df.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF_DIR, "embeddings").collect()]
    want = plain(rows)
    assert want and got(QUERIES["op12_hard_negatives"](spark, SF_DIR)) == want


def test_sql_states_the_same(spark):
    import duckdb
    db = duckdb.connect()
    db.execute(f"create view embeddings as from '{SF_DIR}/embeddings.parquet'")
    columns = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"
    rows = db.execute(f"select {columns} from ({ORACLE['op12_hard_negatives']})").fetchall()
    assert sorted(rows, key=str) == got(QUERIES["op12_hard_negatives"](spark, SF_DIR))


def test_awkward_rows(spark):
    """Nulls, ties, repeated rows and ids, zero vectors, other lengths and clashing names."""
    rng = np.random.default_rng(3)
    base = [(i, [float(v) for v in rng.integers(-2, 3, 4) / 8], int(i % 3)) for i in range(0, 120)]
    rows = base + [(50, base[3][1], 1), (50, base[3][1], 1), (100, None, 1), (100, [0.1, None, 0.2, 0.3], 1),
                   (150, [float("nan")] * 4, 2), (150, [float("inf")] * 4, 2), (200, [0.0] * 4, 0),
                   (None, [0.25] * 4, 1), (None, [0.25] * 4, None), (250, [0.2] * 4, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'a' as row", "1 as x", "2 as code", "3 as anchor")
    assert got(H.mine(spark, frame)) == plain(rows)
    odd = spark.createDataFrame(rows + [(300, [], 1), (350, [0.5], 1)], SCHEMA)
    assert got(H.mine(spark, odd)) == plain(rows)  # vectors of another length take no part
    assert H.mine(spark, frame.limit(0)).count() == 0
    assert H.mine(spark, frame.where("vec_id is null")).count() == 0


def test_blocks_and_pieces_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=8)], int(i % 2)) for i in range(300)]
    index = []
    x = np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(np.int64)
    code, align, length, rest = H.encode(x)
    import pyarrow as pa
    for low in range(0, 300, 100):
        s = slice(low, low + 100)
        index.append(pa.record_batch({
            "row": np.arange(low, low + 100), "vec_id": np.arange(low, low + 100), "label": np.zeros(100, np.int32),
            "x": pa.array(x[s].tolist(), pa.list_(pa.int64())), "code": [c.tobytes() for c in code[s]],
            "align": align[s], "length": length[s], "rest": rest[s]}))
    sizes = [len(b.row) for b in H.blocks(iter(index), 8, rows=150)]
    assert sizes == [200, 100]


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_intervals_hold_every_score_and_drop_many(dim):
    rng = np.random.default_rng(dim)
    hearts = rng.normal(size=(100, dim))[rng.integers(0, 100, 2000)]
    x = np.floor(256 * (hearts + 0.1 * rng.normal(size=(2000, dim))) / np.sqrt(dim)).astype(np.int64)
    x[:5] = 0
    import pyarrow as pa
    code, align, length, rest = H.encode(x)
    index = H.Index(pa.table({
        "row": np.arange(2000), "vec_id": np.arange(2000), "label": np.zeros(2000, np.int32),
        "x": pa.array(x.tolist(), pa.list_(pa.int64())), "code": [c.tobytes() for c in code],
        "align": align, "length": length, "rest": rest}), dim)
    low, high = H.intervals(index, x[:50], np.arange(2000))
    true = x[:50] @ x.T
    assert (low <= true).all() and (true <= high).all()
    bar = np.partition(low, -5, axis=1)[:, -5]
    if dim == 64:  # vectors in groups; those spread evenly in all directions are dropped far less
        assert (high >= bar[:, None])[5:].mean() < 0.1
