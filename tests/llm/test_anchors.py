"""Codes against plain k-means, the SQL twin, and trees against all distances."""

import hashlib

import duckdb
import numpy as np
import pytest

from tablewright.llm import anchors, queries
from tests.llm.conftest import SF_DIR


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max([1, *(len(v) for _, v, _ in kept)]) // parts) * parts
    x = np.array([[int(np.floor(256 * float(c))) for c in [*v, *[0] * (width - len(v))]] for _, v, _ in kept])
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, x[k].tolist()))
    cut = x.reshape(len(kept), parts, -1)
    books = cut[order[:entries]].transpose(1, 0, 2).copy()
    for turn in range(rounds + 1):
        errors = ((cut[:, :, None] - books[None]) ** 2).sum(-1)
        nearest = errors.argmin(-1)
        if turn < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    mine = cut[nearest[:, p] == e, p]
                    if len(mine):
                        books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    error = errors.min(-1).sum(-1)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    total = {}
    for (_, _, label), e in zip(kept, error.tolist()):
        total[label] = total.get(label, 0) + e
    return sorted(
        ((i, "".join(f"{c:02x}" for c in code), e, total[label], digest)
         for (i, _, label), code, e in zip(kept, nearest.tolist(), error.tolist())), key=str
    )


def got(out):
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_query_equals_plain_and_twin(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.table(spark, SF_DIR, "embeddings").collect()]
    found = got(queries.op12_vector_codes(spark, SF_DIR))
    assert found == plain(rows)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    twin = connection.execute(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({queries.VECTOR_CODES_SQL})")
    assert sorted(twin.fetchall(), key=str) == found


SCHEMA = "vec_id long, embedding array<double>, label string, code string, error int, l int"


@pytest.mark.parametrize("chunk", [7, 4096])
def test_odd_rows(spark, chunk):
    source = np.random.default_rng(8)
    rows = [(i, [float(x) for x in source.standard_normal(20)], "ab"[i % 2]) for i in range(200)]
    rows += [(1, rows[7][1], None), (None, rows[8][1], None), (2, rows[2][1], "a"), (300, None, "a"), (301, [None] * 20, "a")]
    rows += [(302, [float("nan")] * 20, "a"), (303, [0.5, -0.5], "b"), (304, [], "b"), (-5, [0.0] * 20, "c")]
    rows += [(400 + i, [0.125] * 20, "hot") for i in range(150)]
    df = spark.createDataFrame([(*r, "z", 1, 2) for r in rows], SCHEMA).repartition(3)
    assert got(anchors.vector_codes(df, chunk=chunk)) == plain(rows)


def test_few_rows_and_none(spark):
    few = [(2, [1.0, 2.0], "a"), (1, [3.0, -4.0], "b"), (1, [3.0, -4.0], "b")]
    assert got(anchors.vector_codes(spark.createDataFrame([(*r, "", 0, 0) for r in few], SCHEMA))) == plain(few)
    for rows in ([], [(1, None, "a", "", 0, 0)]):
        out = anchors.vector_codes(spark.createDataFrame(rows, SCHEMA))
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0


def test_too_large(spark):
    with pytest.raises(Exception, match="beyond"):
        anchors.vector_codes(spark.createDataFrame([(1, [1e12], "a", "", 0, 0)], SCHEMA)).collect()


@pytest.mark.parametrize("kind", ["spread", "clusters", "ties", "one"])
def test_trees_equal_all_distances(kind):
    source = np.random.default_rng(9)
    points = {
        "spread": source.integers(-500, 500, (3000, 4)),
        "clusters": source.integers(-500, 500, (20, 4)).repeat(100, 0) + source.integers(-9, 9, (2000, 4)),
        "ties": source.integers(0, 5, (3000, 3)),
        "one": np.ones((50, 4), int),
    }[kind].astype("int64")
    entries = points[source.integers(0, len(points), 64)]
    tree = anchors.metric_tree(points)
    errors = ((points[:, None] - entries[None]) ** 2).sum(-1)
    nearest, error = anchors.nearest_entries(tree, entries)
    assert (nearest == errors.argmin(1)).all() and (error == errors.min(1)).all()
    totals, numbers = anchors.entry_sums(tree, entries)
    assert (numbers == np.bincount(nearest, minlength=64)).all()
    assert (totals == np.array([points[nearest == k].sum(0) for k in range(64)])).all()


def test_balls_are_owned_as_a_whole():
    source = np.random.default_rng(10)
    centres = source.integers(-5000, 5000, (64, 4))
    points = (centres.repeat(60, 0) + source.integers(-40, 40, (3840, 4))).astype("int64")
    balls, compared, _ = anchors.owners(anchors.metric_tree(points), centres.astype("int64"))
    assert len(balls) < 400 and len(compared) < 400
