"""Exact top-k by inner product, best first in a forest of M-trees.

Vectors are dealt to the nearest of a few pivots, and within a pivot to as many trees of bounded size as its vectors
need, so copies of one vector fill several trees. A tree's nodes are rows of a table, its pages: a routing object, a
covering radius, the distance to the parent's routing object, and either children or at most ``PAGE`` entries with
their distances to the routing object. For a query q and a ball of radius r around c, no inner product exceeds
``q·c + |q| r``; and q·c itself is at most ``q·p + |q| d(p, c)`` for the parent p. So a child, and an entry of a
page, is passed over without computing anything for it where the stored distance already rules it out. A tree is
searched by a block of queries at once: a node is opened by those that its ball may still serve, in one product of
matrices.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import written
from tablewright.llm.vectors import is_finite, matrix, widened

K = 20
#: Entries of a page, children of a routing node, vectors of a tree and queries of a block, at most or on average.
PAGE = 512
FANOUT = 16
TREE_ROWS = 8192
QUERY_BLOCK = 2048
#: Trees whose balls are compared with a block of queries at once.
ROOT_BLOCK = 2048
#: Trees' pivots are taken from the vectors with the smallest hashes of their ids.
MOST_PIVOTS = 256
#: Relative room for rounding in bounds.
SLACK = 1e-9

NODE_SCHEMA = (
    "tree int, node int, parent int, radius double, parent_distance double, centre binary, width int, "
    "ids binary, entries binary, distances binary"
)


@dataclass
class Node:
    parent: int
    centre: np.ndarray
    radius: float
    parent_distance: float
    rows: np.ndarray | None
    distances: np.ndarray | None


def build(vectors: np.ndarray) -> list[Node]:
    """Bulk-load a tree: cut a set around routing objects that lie far from each other until it fits a page."""
    nodes: list[Node] = []
    waiting = [(np.arange(len(vectors)), 0, -1)] if len(vectors) else []
    while waiting:
        rows, routing, parent = waiting.pop()
        centre = vectors[routing] if parent >= 0 else vectors[rows[0]]
        distances = np.linalg.norm(vectors[rows] - centre, axis=1)
        above = float(np.linalg.norm(centre - nodes[parent].centre)) if parent >= 0 else 0.0
        node = Node(parent, centre, float(distances.max()), above, None, None)
        nodes.append(node)
        if len(rows) <= PAGE:
            node.rows, node.distances = rows, distances
            continue
        number = len(nodes) - 1
        for part, chosen in _cut(vectors, rows, distances):
            waiting.append((part, chosen, number))
    return nodes


def _cut(vectors: np.ndarray, rows: np.ndarray, distances: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Parts of ``rows`` with a routing object each: nearest of objects chosen farthest first, or even runs."""
    if distances.max() == 0:  # copies of one vector
        size = max(PAGE, -(-len(rows) // FANOUT))
        return [(rows[k : k + size], int(rows[k])) for k in range(0, len(rows), size)]
    chosen = [int(np.argmax(distances))]
    nearest = np.full(len(rows), np.inf)
    owner = np.zeros(len(rows), int)
    for number in range(FANOUT):
        reach = np.linalg.norm(vectors[rows] - vectors[rows[chosen[number]]], axis=1)
        closer = reach < nearest
        nearest[closer], owner[closer] = reach[closer], number
        farthest = int(np.argmax(nearest))
        if nearest[farthest] == 0 or number == FANOUT - 1:
            break
        chosen.append(farthest)
    parts = [(rows[owner == number], int(rows[at])) for number, at in enumerate(chosen)]
    return [(part, at) for part, at in parts if len(part)]


class Tree:
    """A tree read back from its pages."""

    def __init__(self, pages: pd.DataFrame) -> None:
        pages = pages.sort_values("node")
        width = int(pages.width.iloc[0])
        self.width = width
        self.centres = np.array([np.frombuffer(x, "float64") for x in pages.centre]).reshape(-1, width)
        self.radius, self.above = pages.radius.to_numpy(), pages.parent_distance.to_numpy()
        parents = pages.parent.to_numpy()
        self.children = [np.flatnonzero(parents == k) for k in range(len(pages))]
        self.ids = [np.frombuffer(x, "int64") for x in pages.ids]
        self.entries = [np.frombuffer(x, "float64").reshape(-1, width) for x in pages.entries]
        self.distances = [np.frombuffer(x, "float64") for x in pages.distances]
        self.largest = max((float(np.abs(x).max(initial=0)) for x in self.entries), default=0.0)

    def search_block(
        self, asked: np.ndarray, own: np.ndarray, k: int, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``search``, for each row of ``asked``: (number of the query, id, score) of the best.

        Nodes are opened in the order of the best bound that any query has for them.
        """
        if self.width * self.largest * float(np.abs(asked).max(initial=0)) >= 1 << 52:  # doubles could round a sum
            found = [self.search(*row, k, reach) for row, reach in zip(zip(asked, own, strict=True), least, strict=True)]
            flat = [(row, *pair) for row, pairs in enumerate(found) for pair in pairs]
            return tuple(np.array([x[part] for x in flat], "int64") for part in range(3))
        lengths = np.linalg.norm(asked, axis=1)
        slack = SLACK * (1 + lengths * (1 + float(np.abs(self.centres).max(initial=0)) * self.width))
        least = least.astype("float64")
        rows, ids, scores = np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0)
        products = asked @ self.centres[0]
        waiting = [(0.0, 0, np.arange(len(asked)), products)]
        while waiting:
            _, node, who, products = heapq.heappop(waiting)
            open_ = products + lengths[who] * self.radius[node] + slack[who] >= least[who]
            who, products = who[open_], products[open_]
            if not len(who):
                continue
            base, length, needed = (products + slack[who])[:, None], lengths[who][:, None], least[who][:, None]
            children = self.children[node]
            if len(children):
                # Stored distances first: no product with a child that they rule out for all queries.
                may = base + length * (self.above[children] + self.radius[children]) >= needed
                some = np.flatnonzero(may.any(axis=0))
                inner = asked[who] @ self.centres[children[some]].T
                bounds = inner + length * self.radius[children[some]] + slack[who][:, None]
                may = may[:, some] & (bounds >= needed)
                for place, child in enumerate(children[some].tolist()):
                    mine = may[:, place]
                    if mine.any():
                        best = float(bounds[mine, place].max())
                        heapq.heappush(waiting, (-best, child, who[mine], inner[mine, place]))
                continue
            may = (base + length * self.distances[node] >= needed).any(axis=0)
            page, page_ids = self.entries[node], self.ids[node]
            if not may.all():
                page, page_ids = page[may], page_ids[may]
            if not len(page):
                continue
            found = asked[who] @ page.T
            found[page_ids == own[who][:, None]] = -np.inf
            if len(page) > k:
                needed = np.maximum(needed, np.partition(found, len(page) - k, axis=1)[:, -k, None])
            row, at = np.nonzero((found >= needed) & (found > -np.inf))
            if not len(row):
                continue
            rows, ids = np.concatenate([rows, who[row]]), np.concatenate([ids, page_ids[at]])
            scores = np.concatenate([scores, found[row, at]])
            order = np.lexsort((ids, -scores, rows))
            rank = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
            kept = order[rank < k]
            last = order[rank == k - 1]
            least[rows[last]] = np.maximum(least[rows[last]], scores[last])
            rows, ids, scores = rows[kept], ids[kept], scores[kept]
        return rows, ids, scores.astype("int64")

    def search(self, query: np.ndarray, own: int, k: int, least: float = -np.inf) -> list[tuple[int, int]]:
        """The ``k`` best (id, score) without the query's own row, of those that reach ``least``; ties go to smaller ids."""
        length = float(np.linalg.norm(query))
        slack = SLACK * (1 + length * (1 + float(np.abs(self.centres).max(initial=0)) * self.width))
        ids, scores = np.empty(0, "int64"), np.empty(0)
        product = float(self.centres[0] @ query)
        waiting = [(-(product + length * self.radius[0]), 0, product)]
        while waiting and -waiting[0][0] + slack >= least:
            _, node, product = heapq.heappop(waiting)
            children = self.children[node]
            if len(children):
                # Stored distances first: no product with a child that they rule out.
                reach = product + length * (self.above[children] + self.radius[children])
                children = children[reach + slack >= least]
                products = self.centres[children] @ query
                bounds = products + length * self.radius[children]
                for child, inner, bound in zip(children.tolist(), products.tolist(), bounds.tolist(), strict=True):
                    if bound + slack >= least:
                        heapq.heappush(waiting, (-bound, child, inner))
                continue
            open_ = product + length * self.distances[node] + slack >= least
            page = self.entries[node] if open_.all() else self.entries[node][open_]
            found, own_ids = exact_products(page, query), self.ids[node][open_]
            better = (found >= least) & (own_ids != own)
            ids, scores = np.concatenate([ids, own_ids[better]]), np.concatenate([scores, found[better]])
            if len(ids) > k:
                if scores.dtype == object:
                    best = sorted(range(len(ids)), key=lambda at, s=scores, i=ids: (-s[at], i[at]))[:k]
                else:
                    best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                least = max(least, scores.min())
        scores = [int(x) for x in scores]
        if any(abs(x) >= 1 << 63 for x in scores):
            raise ValueError("an inner product does not fit a long")
        return list(zip(ids.tolist(), scores, strict=True))


def exact_products(page: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of vectors of whole numbers; as Python's integers where doubles could round a sum."""
    if (np.abs(page) @ np.abs(query)).max(initial=0) < 1 << 52:
        return page @ query
    whole = [int(x) for x in query]
    found = np.empty(len(page), object)
    found[:] = [sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in page.tolist()]
    return found


def _vectors(table: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    valid = table.where(F.col(id_col).isNotNull() & is_finite(F.col(vector_col)))
    scaled = F.transform(vector_col, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    return valid.select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))


def _dealt(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Add ``tree``: that of the nearest pivot, and of a share of its vectors where they are too many for one."""
    count = vectors.count()
    pivots = min(MOST_PIVOTS, max(1, count // TREE_ROWS))
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toArrow()
    centres = matrix(chosen.column("v"))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("v"))
            width = max(v.shape[1], centres.shape[1])
            a, b = widened(v, width), widened(centres, width)
            pivot = np.argmin((b * b).sum(1) - 2 * (a @ b.T), axis=1) if len(b) else np.zeros(len(a))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot.astype("int32"))], ["id", "v", "pivot"])

    near = written(vectors.mapInArrow(nearest, "id long, v array<double>, pivot int"), "pivots")
    sizes = {r.pivot: r.n for r in near.groupBy("pivot").agg(F.count("*").alias("n")).collect()}
    trees, first = {}, 0
    for pivot, size in sorted(sizes.items()):
        trees[pivot] = (first, -(-size // TREE_ROWS))
        first += trees[pivot][1]
    table = F.create_map(*(x for p, (low, n) in trees.items() for x in (F.lit(p), F.array(F.lit(low), F.lit(n)))))
    if not trees:
        return near.withColumn("tree", F.lit(0)).drop("pivot"), 0
    place = table[F.col("pivot")]
    return near.select("id", "v", (place[0] + F.pmod(F.xxhash64("id", "v"), place[1])).cast("int").alias("tree")), first


def _pages(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("id")
    width = max(map(len, group.v))
    vectors = np.array([np.pad(v, (0, width - len(v))) for v in group.v]).reshape(len(group), width)
    ids, tree = group.id.to_numpy(), int(group.tree.iloc[0])
    nothing = np.empty(0, "int64")
    rows = []
    for number, node in enumerate(build(vectors)):
        own = nothing if node.rows is None else node.rows
        distances = np.empty(0) if node.distances is None else node.distances
        rows.append(
            (tree, number, node.parent, node.radius, node.parent_distance, node.centre.tobytes(), width)
            + (ids[own].tobytes(), vectors[own].tobytes(), distances.tobytes())
        )
    return pd.DataFrame(rows, columns=[part.split()[0] for part in NODE_SCHEMA.split(", ")])


def top_k(
    table: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: float = 64.0,
) -> DataFrame:
    """The ``k`` rows of ``table`` with the largest inner products for each row of ``queries``, its own id excepted.

    Components are turned into ``floor(scale * x)`` first. Columns ``query_id``, ``rank`` from 1, the id and
    ``score``; ties go to the smaller id; queries with fewer candidates have fewer rows. Rows with a NULL id or a
    vector that is NULL or not finite take no part; vectors of different lengths are multiplied as if the shorter
    went on with zeros. Rows that repeat an id are candidates of their own; a repeated query row counts once, with
    the first of its vectors. Scores are exact; one that does not fit a long is an error.
    """
    dealt, trees = _dealt(_vectors(table, id_col, vector_col, scale))
    pages = written(dealt.groupBy("tree").applyInPandas(_pages, NODE_SCHEMA), "pages")
    asked = _vectors(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    asked = written(asked, "queries")
    blocks = 1 + asked.count() // QUERY_BLOCK
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    if trees <= 1:
        return _ranked(_searched(pages, asked.select("*", F.lit(0).alias("tree"), F.lit(None).cast("double").alias("least")), k), k, id_col)
    roots = pages.where("parent < 0").select("tree", "centre", "radius", "width")
    nothing_yet = asked.withColumn("least", F.lit(None).cast("double"))
    promising = _promising(roots, nothing_yet, trees).groupBy("id").agg(F.max_by("tree", F.struct("bound", "tree")).alias("tree"))
    starts = written(nothing_yet.join(promising, "id"), "starts")
    first = written(_searched(pages, starts, k), "first-trees")
    # A score that is rounded down here asks for no more than it is.
    reached = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") >= k)
    least = reached.select(F.col("query_id").alias("id"), (F.col("score") - F.abs("score") * 1e-15).alias("least"))
    known = written(asked.join(starts.select("id", F.col("tree").alias("start")), "id").join(least, "id", "left"), "known")
    onward = _promising(roots, known, trees).join(known, "id").where("tree != start").select("id", "v", "block", "least", "tree")
    further = _searched(pages, written(onward, "onward"), k)
    return _ranked(first.unionByName(further), k, id_col)


def _padded(vectors: Iterable[np.ndarray], width: int) -> np.ndarray:
    """The vectors as rows of a matrix, with zeros behind them; what lies beyond its width is cut."""
    vectors = list(vectors)
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector[:width]
    return out


def _reached(least: pd.Series) -> np.ndarray:
    """The score that a query asks for; any, if it has none yet."""
    return least.astype("float64").fillna(-np.inf).to_numpy()


def _promising(roots: DataFrame, asked: DataFrame, trees: int) -> DataFrame:
    """``id``, ``tree`` and ``bound`` of the trees whose balls reach ``least`` of a query, or of the best ball of a
    block of trees where a query has no ``least`` and ``start`` yet. Blocks of balls meet blocks of queries."""
    blocks = -(-trees // ROOT_BLOCK)
    first = "start" not in asked.columns
    cells = asked.select(F.max("block")).first()[0] or 0
    left = roots.withColumn("part", F.pmod("tree", F.lit(blocks))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(cells)))
    )
    right = asked.select("id", "v", "block", "least").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def bounds(balls: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if len(balls) and len(block):
            centres = [np.frombuffer(x, "float64") for x in balls.centre]
            width = max(max(map(len, centres)), max(map(len, block.v)))
            centres, asked = _padded(centres, width), _padded(block.v, width)
            radius, numbers = balls.radius.to_numpy(), balls.tree.to_numpy()
            lengths = np.linalg.norm(asked, axis=1)[:, None]
            largest = float(np.abs(centres).max(initial=0))
            reach = asked @ centres.T + lengths * radius + SLACK * (1 + lengths * (1 + largest * width))
            if first:
                row, at = np.arange(len(block)), reach.argmax(axis=1)
            else:
                row, at = np.nonzero(reach >= _reached(block.least)[:, None])
            return pd.DataFrame({"id": block.id.to_numpy()[row], "tree": numbers[at], "bound": reach[row, at]})
        return pd.DataFrame({"id": [], "tree": [], "bound": []})

    return (
        left.groupBy("part", "block")
        .cogroup(right.groupBy("part", "block"))
        .applyInPandas(bounds, "id long, tree int, bound double")
    )


def _searched(pages: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``_vec``, ``score``: the best of the tree that each row of ``asked`` (``id``, ``v``, ``block``,
    ``tree``, ``least``) names. Pages go only to blocks of queries that ask for their tree."""
    left = pages.join(written(asked.select("tree", "block").distinct(), "cells"), "tree")

    def searched(pages: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if len(pages) and len(block):
            tree, own = Tree(pages), block.id.to_numpy()
            row, ids, scores = tree.search_block(_padded(block.v, tree.width), own, k, _reached(block.least))
            return pd.DataFrame({"query_id": own[row], "_vec": ids, "score": scores})
        return pd.DataFrame({"query_id": [], "_vec": [], "score": []})

    return (
        left.groupBy("tree", "block")
        .cogroup(asked.groupBy("tree", "block"))
        .applyInPandas(searched, "query_id long, _vec long, score long")
    )


def _ranked(found: DataFrame, k: int, id_col: str) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "_vec")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("_vec").alias(id_col), "score")
    )
