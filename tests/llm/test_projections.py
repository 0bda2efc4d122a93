"""Links and groups of vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import projections, queries
from tests.llm.conftest import SF_DIR
from tests.llm.test_simhash import plain_groups


def plain(rows, threshold=0.95):
    valid = {}
    for number, (_, v) in enumerate(rows):
        good = v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and rows[number][0] is not None
        if good:
            valid[number] = np.array(v, "float64")
    width = max((len(v) for v in valid.values()), default=0)
    keys = list(valid)
    m = np.array([np.pad(valid[k], (0, width - len(valid[k]))) for k in keys]).reshape(len(keys), width)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True) if keys else m
    close = unit @ unit.T >= threshold - 1e-15
    np.fill_diagonal(close, False)
    at = {k: n for n, k in enumerate(keys)}
    label = plain_groups(keys, lambda a, b: close[at[a], at[b]])
    first = {}
    for k in keys:
        first[label[k]] = min(first.get(label[k], rows[k][0]), rows[k][0])
    return sorted(
        ((r[0], int(close[at[n]].sum()), first[label[n]]) if n in at else (r[0], 0, r[0]) for n, r in enumerate(rows)),
        key=str,
    )


def got(out):
    rows = out.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


def clustered(seed, clusters, size, noise):
    source = np.random.default_rng(seed)
    rows = []
    for centre in source.standard_normal((clusters, 16)):
        rows += [centre + noise * source.standard_normal(16) for _ in range(size)]
    return [(1000 + i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def test_query_equals_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, SF_DIR, "embeddings").collect()]
    assert got(queries.op8_embedding_near_dedup(spark, SF_DIR)) == plain(rows)


@pytest.mark.parametrize("block, window", [(1024, 64), (7, 5)])
def test_large_groups(spark, monkeypatch, block, window):
    monkeypatch.setattr(projections, "BLOCK", block)
    rows = clustered(3, 6, 40, 0.1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert got(projections.near_duplicate_vectors(df, window=window)) == plain(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 1.0]), (None, [1.0, 2.0]),
        (7, [1.0, 2.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (8, [-5.0, 1.0]), (9, [2.0, 4.0, 0.0]), (10, [1.0, 2.0, 9.0]), (11, [-1.0, -2.0]),
    ]
    full = [(i, v, "x", 5) for i, v in rows]
    df = spark.createDataFrame(full, "vec_id long, embedding array<double>, node string, n_links int")
    assert got(projections.near_duplicate_vectors(df)) == plain(rows)
    assert projections.near_duplicate_vectors(df.limit(0)).collect() == []


def test_many_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(900, [3.0, -1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert got(projections.near_duplicate_vectors(df)) == plain(rows)


def dense(seed, members, others, width=32):
    """Vectors of which a cluster (mean cosine 0.87) has every second one a partner at cosine 0.955."""
    source = np.random.default_rng(seed)

    def units(n):
        v = source.standard_normal((n, width))
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    centre, noise = units(1), units(members)
    noise -= (noise @ centre.T) * centre
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cluster = np.sqrt(0.87) * centre + np.sqrt(0.13) * noise
    aside = units(members)
    aside -= np.sum(aside * cluster, axis=1, keepdims=True) * cluster
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    partners = 0.955 * cluster + np.sqrt(1 - 0.955**2) * aside
    return np.concatenate([cluster, partners[::2], units(others)])


def test_dense_cluster(spark):
    members = 3000
    vectors = dense(5, members, 5000)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    out = {r.vec_id: r for r in projections.near_duplicate_vectors(df, window=8).collect()}
    cosine = vectors @ vectors.T
    np.fill_diagonal(cosine, 0)
    links = (cosine >= 0.95).sum(axis=1)
    assert len(out) == len(rows)
    assert all(out[i].n_links <= links[i] for i in out)
    assert sum(r.n_links for r in out.values()) >= 0.9 * links.sum()
    together = [out[2 * k].component_id == out[members + k].component_id for k in range(members // 2)]
    assert np.mean(together) >= 0.9


@pytest.mark.parametrize("partitions", [40, 200])
def test_windows_reach_over_small_and_empty_partitions(spark, partitions):
    rows = clustered(4, 3, 15, 0.1)
    df = spark.createDataFrame(rows, "node long, v array<float>").withColumn("keys", F.expr("array(node div 20, 0L)"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        edges = [(r.a, r.b) for r in projections.window_edges(df, 0.95, 45).collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    vectors = np.array([v for _, v in rows])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    nodes = [n for n, _ in rows]
    wanted = plain_groups(nodes, lambda a, b: close[a - 1000, b - 1000])
    linked = plain_groups(nodes, lambda a, b: (a, b) in edges or (b, a) in edges)
    assert linked == wanted


def test_boundaries():
    assert projections._near_boundaries([(3, 10)], 4) == []
    assert projections._near_boundaries([(0, 10), (2, 1), (5, 10), (6, 10)], 4) == [
        (0, 0, 10), (0, 0, 11), (2, 10, 10), (2, 10, 11), (5, 11, 10), (5, 11, 11), (5, 11, 21), (6, 21, 21),
    ]


def test_probes_are_partners_at_the_threshold(spark):
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(np.random.default_rng(1).standard_normal((400, 8)))]
    rows += [(400 + k, [1.0]) for k in range(100)]
    made = projections.probes(spark.createDataFrame(rows, "node long, v array<float>"), 0.95, len(rows)).collect()
    assert made and all(0 <= -1 - r.node < 400 for r in made)
    for row in made:
        v = np.array(rows[-1 - row.node][1])
        assert 0.95 <= v @ np.array(row.v) / np.linalg.norm(v) / np.linalg.norm(row.v) < 0.9501
