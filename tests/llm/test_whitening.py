"""Whitened vectors against a dense eigen-decomposition, and the solver on matrices of its own."""

import numpy as np
import pytest

from tablewright.llm import queries, whitening
from tests.llm.conftest import SF_DIR


def plain(rows, wanted=16):
    """(id, deviations, whitened, explained) by the dense way; columns of ``whitened`` have any sign."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in [*v, *[0] * (width - len(v))]] for _, v in kept])
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    real = values > 1e-11 * values[0]
    trace = np.trace(centred.T @ centred / len(fit))
    values, vectors = values[real], vectors[:, real]
    deviations = [sum(int(d) ** 2 for d in len(fit) * row - fit.sum(0)) for row in x]
    return [i for i, _ in kept], len(fit), deviations, (x - fit.mean(0)) @ vectors / np.sqrt(values), values / trace


def check(out, rows, tolerance=1e-8):
    ids, n, deviations, whitened, explained = plain(rows)
    got = out.collect()
    k = len(explained)
    assert len(got) == len(ids) * k
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4
    assert sorted((str(r[0]), r.deviation) for r in got) == sorted((str(i), d) for i, d in zip(ids, deviations) for _ in range(k))
    for component in range(1, k + 1):
        mine = sorted((str(r[0]), r.deviation, r.whitened) for r in got if r.component == component)
        theirs = sorted(zip(map(str, ids), deviations, whitened[:, component - 1]))
        a, b = np.array([m[2] for m in mine]), np.array([t[2] for t in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < tolerance
        assert {r.explained for r in got if r.component == component} == {got[[r.component for r in got].index(component)].explained}
    assert np.allclose([next(r.explained for r in got if r.component == c + 1) for c in range(k)], explained, rtol=1e-10)


def test_query_equals_dense_decomposition(spark):
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, SF_DIR, "embeddings").collect()]
    check(queries.op11_embedding_whitening(spark, SF_DIR), rows)


def test_odd_rows(spark):
    source = np.random.default_rng(4)
    rows = [(i, [float(x) for x in source.standard_normal(6) * (1, 2, 3, 4, 5, 6)]) for i in range(80)]
    rows += [(None, rows[0][1]), (3, rows[1][1]), (90, None), (91, [1.0, None] * 3), (92, [float("nan")] * 6)]
    rows += [(93, [float("inf")] * 6), (94, [0.5, -0.5]), (95, [])]
    df = spark.createDataFrame([(*r, 1, 2.0, 3) for r in rows], "vec_id long, embedding array<double>, n long, whitened double, x int")
    check(whitening.whiten(df.repartition(5)), rows)


def test_no_component_without_spread(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [0.25, 3.0])], [(1, [0.25, 3.0]), (2, [0.25, 3.0])], [(1, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, schema))
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = spark.createDataFrame([(i, [i / 64, 2.0 * i / 64, 1.0]) for i in range(10)], schema)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}


def test_numbers_beyond_longs(spark):
    rows = [(i, [float(1 << 33) * (i % 3), float(i)]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in got} == {None} or all(r.deviation is None or r.deviation < 1 << 63 for r in got)
    assert got[0].identity_error < 1e-4
    with pytest.raises(Exception, match="beyond"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize("shape", ["flat", "falling", "repeated", "low rank"])
def test_solver(shape):
    source = np.random.default_rng(5)
    size = 150
    turn = np.linalg.qr(source.standard_normal((size, size)))[0]
    values = {
        "flat": np.linspace(1, 1.5, size),
        "falling": 1 / np.arange(1.0, size + 1) ** 2,
        "repeated": np.repeat([5.0, 4.0, 3.0], size // 3),
        "low rank": np.r_[np.arange(1.0, 10), np.zeros(size - 9)],
    }[shape]
    matrix = turn * values @ turn.T
    passes = []

    def product(columns):
        passes.append(columns.shape[1])
        return matrix @ columns

    found, vectors = whitening.leading_pairs(product, size, 16)
    assert np.allclose(found, np.sort(values)[::-1][:16], atol=1e-12)
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12
    assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-12)
    assert max(passes) <= 20


def test_minres_solves_each_system():
    source = np.random.default_rng(6)
    matrix = source.standard_normal((40, 40))
    matrix = matrix + matrix.T
    shifts, right = np.array([0.3, 5.0, -2.0]), source.standard_normal((40, 3))
    solved = whitening.minres_together(lambda c, which: matrix @ c - c * shifts[which], right, 400)
    left = np.linalg.norm(matrix @ solved - solved * shifts - right, axis=0) / np.linalg.norm(right, axis=0)
    assert (left <= whitening.INNER_REDUCTION * 1.01).all()
