import numpy as np
import pytest

from fareledger.llm import whitening as W
from fareledger.llm.common import table
from fareledger.llm.jacobi_davidson import EPS, largest, minres
from fareledger.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def plain(rows):
    """{vec_id: [...]} by a dense eigensolver on the distinct whole-number vectors."""
    kept = [(i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)) for i, v in rows
            if v is not None and not any(c is None or not np.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in kept:
        off = n * np.array(x) - sums
        for k in range(min(4, len(x))):
            flat = values[k] <= 1e-12 * max(values.sum(), 1e-300)
            out.append((i, k + 1, n, int((off * off).sum()),
                        0.0 if flat else abs(off / n @ vectors[:, k]) / np.sqrt(values[k]),
                        0.0 if flat else values[k] / values.sum()))
    return out


def check(df, rows):
    got = df.collect()
    key = (lambda r: (str(r[0]), r[1], r[3], round(r[4], 6)))
    mine = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=key)
    want = sorted(plain(rows), key=key)
    assert [r[:4] for r in mine] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in mine], [r[4:] for r in want], rtol=1e-8, atol=1e-9)
    assert len({r.identity_error for r in got}) <= 1 and all(r.identity_error < 1e-10 for r in got)


def test_whole_table_equals_a_dense_solver(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_DIR, "embeddings").collect()]
    check(QUERIES["op11_whitening"](spark, SF_DIR), rows)


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=6) * [5, 4, 3, 2, 1, 1]]) for i in range(60)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (70, rows[5][1]), (71, None), (72, [None] * 6),
             (73, [float("nan")] * 6), (74, [float("-inf")] + [0.0] * 5), (75, [0.0] * 6)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'a' as x", "1 as n", "2 as component", "3 as block")
    check(W.whitening(frame), rows)
    check(W.whitening(spark.createDataFrame(rows + [(90, []), (91, [1.0])], SCHEMA)), rows)
    empty = W.whitening(frame.limit(0))
    assert empty.count() == 0 and empty.columns == [c.split()[0] for c in W.OUT.split(", ")]


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 2.0, 3.0])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, [1.0]), (2, [2.0]), (3, [4.0])],
    [(1, [1.0, 2.0, 3.0, 4.0, 5.0]), (2, [2.0, 1.0, 3.0, 4.0, 5.0])]])
def test_few_vectors_and_dimensions(spark, rows):
    check(W.whitening(spark.createDataFrame(rows, SCHEMA)), rows)


def test_deviations_beyond_a_double():
    x = np.array([[2**40, -3], [5, 7]])
    n, sums = 10**6, [10**12, 9]
    centred, squares = W.deviations(x, n, sums)
    exact = [sum((n * int(v) - s)**2 for v, s in zip(row, sums)) for row in x]
    assert squares == [e if e < 2**63 else None for e in exact] and squares[0] is None
    assert np.allclose(centred, (x * n - np.array(sums)) / n)


@pytest.mark.parametrize("gap", ["clusters", "flat", "low rank", "equal"])
@pytest.mark.parametrize("dim", [3, 64, 300])
def test_solver_reaches_double_precision(dim, gap):
    rng = np.random.default_rng(dim)
    values = {"clusters": np.r_[5, 4.9, 4.8, 3, rng.uniform(0, 1, dim)][:dim], "flat": rng.uniform(0.9, 1, dim),
              "low rank": np.r_[3.0, 2, np.zeros(dim)][:dim], "equal": np.ones(dim)}[gap]
    q = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    matrix, passes = (q * values) @ q.T, []

    def times(u):
        passes.append(u.shape[1])
        return matrix @ u
    found, vectors = largest(times, dim, 4)
    assert np.allclose(found, np.sort(values)[::-1][:4], atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 4096 * EPS * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13
    print(dim, gap, len(passes))


def test_minres_solves():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    right = rng.normal(size=(20, 3))
    assert np.allclose(a @ minres(lambda t: a @ t, right, 60, 1e-13), right, atol=1e-8)
