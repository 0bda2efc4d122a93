"""Top-k against all products, and against the SQL twin."""

import time

import duckdb
import numpy as np
import pandas as pd
import pytest

from tablewright.llm import mtree, queries
from tests.llm.conftest import SF_DIR


def plain(rows, asked, k=20):
    def whole(v):
        return [int(np.floor(64 * float(x))) for x in v]

    valid = [(i, whole(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in valid:
        if q in asked:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in valid if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(out):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out.collect())


def test_query_equals_all_products_and_twin(spark):
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, SF_DIR, "embeddings").collect()]
    found = got(queries.op7_exact_top_k(spark, SF_DIR))
    assert found == plain(rows, {i for i, _ in rows if i % 20 == 0})
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    twin = connection.execute(f"SELECT query_id, rank, vec_id, score FROM ({queries.TOP_K_SQL})").fetchall()
    assert sorted(twin) == found


@pytest.mark.parametrize("page, tree", [(512, 8192), (8, 8192), (8, 60)])
def test_trees_of_any_shape(spark, monkeypatch, page, tree):
    monkeypatch.setattr(mtree, "PAGE", page)
    monkeypatch.setattr(mtree, "TREE_ROWS", tree)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 9)
    source = np.random.default_rng(4)
    rows = [(i, [float(x) for x in source.standard_normal(6)]) for i in range(200)]
    rows += [(200 + i, [0.5] * 6) for i in range(100)]  # copies, more than a page
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, tree string, rank int")
    asked = {i for i, _ in rows if i % 10 == 0}
    assert got(mtree.top_k(df, df.where("vec_id % 10 = 0"))) == plain(rows, asked)


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [1.0, None]), (4, []), (20, [0.0, 0.0]), (None, [1.0, 1.0]),
            (5, [1.0, 2.0]), (6, [1.0, 2.0]), (40, [float("inf"), 0.0]), (7, [3.0, 1.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(mtree.top_k(df, df.where("vec_id % 20 = 0"))) == plain(rows, {0, 20, 40})
    assert mtree.top_k(df.limit(0), df.limit(0)).collect() == []
    assert mtree.top_k(df.limit(0), df).collect() == []


def test_bounds_spare_products():
    source = np.random.default_rng(9)
    centres = source.standard_normal((30, 8)) * 50
    vectors = np.repeat(centres, 100, axis=0) + source.standard_normal((3000, 8))
    import pandas as pd

    pages = mtree._pages(pd.DataFrame({"id": range(3000), "v": list(vectors), "tree": 0}))
    tree = mtree.Tree(pages)
    read = []

    class Counting(list):
        def __getitem__(self, k):
            read.append(k)
            return super().__getitem__(k)

    tree.entries = Counting(tree.entries)
    best = np.argsort(-(vectors @ vectors[5]))[:21]
    assert {i for i, _ in tree.search(vectors[5], 5, 20)} == set(best.tolist()) - {5} or 5 not in best
    leaves = sum(len(x) > 0 for x in tree.ids)
    assert len(set(read)) < leaves


def test_scores_beyond_doubles(spark):
    rows = [(i, [float(2**24 + i), 1.0, float(2**23 - i % 3)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = got(mtree.top_k(df, df.where("vec_id % 10 = 0")))
    assert max(score for *_, score in found) > 2**53
    assert found == plain(rows, {0, 10, 20})


def test_scores_beyond_a_long_are_an_error(spark):
    rows = [(i, [float(2**30), 1.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        mtree.top_k(df, df).collect()


def test_repeated_ids_and_queries(spark):
    rows = [(1, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.5, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.where("vec_id = 2")
    found = got(mtree.top_k(df, asked.unionByName(asked)))
    assert [(i, score) for _, _, i, score in found] == [(1, 3 * 4096), (1, 3 * 4096), (3, -2048)]


def test_queries_go_only_to_trees_that_can_answer(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 50)
    monkeypatch.setattr(mtree, "ROOT_BLOCK", 7)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 16)
    source = np.random.default_rng(2)
    centres = 40 * np.eye(4, 20)
    rows = [(i, [float(x) for x in centres[i % 4] + 0.2 * source.standard_normal(20)]) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent = []
    searched = mtree._searched
    monkeypatch.setattr(mtree, "_searched", lambda pages, asked, k: (sent.append(asked.count()), searched(pages, asked, k))[1])
    found = got(mtree.top_k(df, df.where("vec_id % 10 = 0")))
    assert found == plain(rows, {i for i in range(0, 1000, 10)})
    trees = 1000 // 50  # at least
    assert sent[0] == 100 and sum(sent) < 100 * trees / 2


def tree_of(vectors):
    return mtree.Tree(mtree._pages(pd.DataFrame({"id": range(len(vectors)), "v": list(vectors), "tree": 0})))


@pytest.mark.parametrize("scale", [1, 1 << 26])
def test_a_block_of_queries_finds_what_each_finds(monkeypatch, scale):
    monkeypatch.setattr(mtree, "PAGE", 16)
    source = np.random.default_rng(5)
    vectors = np.floor(source.standard_normal((700, 6)) * 4) * scale  # many ties
    vectors[100:200] = vectors[7]
    tree, own = tree_of(vectors), np.array([0, 7, 150, 699, 1000])
    asked = np.vstack([vectors[own[:-1]], np.zeros((1, 6))])
    least = np.array([-np.inf, -np.inf, 30.0 * scale**2, 1e300, -np.inf])
    rows, ids, scores = tree.search_block(asked, own, 20, least)
    for number in range(len(own)):
        mine = sorted((-s, i) for r, i, s in zip(rows.tolist(), ids.tolist(), scores.tolist(), strict=True) if r == number)
        products = [(-sum(int(a) * int(b) for a, b in zip(v, asked[number], strict=True)), i) for i, v in enumerate(vectors)]
        assert mine == sorted(p for p in products if p[1] != own[number] and -p[0] >= least[number])[:20]


def test_work_of_a_block_is_not_work_of_each_query():
    """1,000 queries that no bound serves, against a tree of 8,000 vectors."""
    source = np.random.default_rng(6)
    vectors = np.floor(64 * source.standard_normal((8000, 64)))
    tree = tree_of(vectors)
    begin = time.process_time()
    rows, ids, scores = tree.search_block(vectors[:1000], np.arange(1000), 20, np.full(1000, -np.inf))
    block = time.process_time() - begin
    begin = time.process_time()
    each = [(i, *x) for i in range(200) for x in tree.search(vectors[i], i, 20)]
    alone = (time.process_time() - begin) * 5
    assert sorted(each) == sorted(x for x in zip(rows.tolist(), ids.tolist(), scores.tolist(), strict=True) if x[0] < 200)
    assert block < alone
