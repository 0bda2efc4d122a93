"""Near-duplicate vectors by sorted projection passes.

Each pass orders the distinct vectors lexicographically by a few concatenated random hashes (signs of random
projections) and compares every vector with a bounded number of successors. Verified pairs of all passes are united.
Within the groups so found all pairs are compared once, in blocks, which gives the exact numbers of links inside a
group whatever its size: windows only decide what is grouped.

How many passes that takes depends on how dense the vectors lie, so it is measured: probes, made-up partners of some
vectors at the threshold itself, are sorted in with the rest, and rounds of passes with further hashes and wider
windows follow until nearly all probes have been grouped with the vectors they were made for.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import written
from tablewright.llm.components import connected_components
from tablewright.llm.simhash import _forest
from tablewright.llm.vectors import is_finite, matrix, widened

THRESHOLD = 0.95
#: Passes in a round, and the window in the first one; it grows from round to round up to the widest.
PASSES = 12
WINDOW, WIDEST, WIDENING = 64, 1024, 4
#: About how many vectors get a probe (at most one of 16), and the share of the probes that has to be found.
PROBES, PROBES_FOUND = 2048, 0.98
#: Random hashes that are concatenated to a key, and the signs in each.
HASHES, SIGNS = 4, 15
SEED = 20_240_501
#: Members of a group that are compared with each other, or with as many others, in one task.
BLOCK = 1024


@functools.cache
def _planes(dimension: int, turn: int) -> np.ndarray:
    """What a component counts in each projection of a round; it does not depend on the number of components."""
    return np.random.default_rng([SEED, dimension, turn]).standard_normal(PASSES * HASHES * SIGNS)


def sort_keys(vectors: np.ndarray, turn: int = 0) -> np.ndarray:
    """A sort key per vector and pass of a round: the first hash decides, then the next."""
    planes = np.array([_planes(k, turn) for k in range(vectors.shape[1])]).reshape(vectors.shape[1], -1)
    signs = (vectors @ planes >= 0).reshape(len(vectors), PASSES, HASHES * SIGNS)
    return signs @ (1 << np.arange(HASHES * SIGNS - 1, -1, -1, dtype="int64"))


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Where rows of ``a`` and ``b`` have a cosine of at least ``threshold``."""
    lengths_a, lengths_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    cosine = (a / lengths_a[:, None]) @ (b / lengths_b[:, None]).T
    close = cosine >= threshold
    # Where rounding could decide, the plain formula does.
    for i, j in np.argwhere(np.abs(cosine - threshold) < 1e-12):
        close[i, j] = a[i] @ b[j] / (lengths_a[i] * lengths_b[j]) >= threshold
    return close


def probe_of(vector: np.ndarray, threshold: float, seed: int) -> np.ndarray | None:
    """A vector in a random direction whose cosine with ``vector`` is the threshold (a little more, so that rounding
    does not matter); None where there is no such direction."""
    unit = vector / np.linalg.norm(vector)
    aside = np.random.default_rng([SEED, seed]).standard_normal(len(unit))
    aside -= (aside @ unit) * unit
    length = np.linalg.norm(aside)
    if length < 1e-9:
        return None
    cosine = min(1.0, threshold + 1e-5)
    return cosine * unit + np.sqrt(1 - cosine * cosine) * aside / length


def probes(nodes: DataFrame, threshold: float, count: int) -> DataFrame:
    """Probes of some of the ``count`` rows of ``nodes`` (``node``, ``v``); that of node ``k`` is node ``-1 - k``."""
    kind = nodes.schema["v"].dataType.simpleString()
    item = pa.float32() if kind == "array<float>" else pa.float64()
    some = nodes.where(F.pmod(F.xxhash64("node"), F.lit(max(16, count // PROBES))) == 0)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = zip(batch.column("node").to_pylist(), batch.column("v").to_pylist(), strict=True)
            found = [(node, probe_of(np.asarray(v, "float64"), threshold, node)) for node, v in sources]
            found = [(-1 - node, probe) for node, probe in found if probe is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([list(v) for _, v in found], pa.list_(item))],
                ["node", "v"],
            )

    return some.mapInArrow(made, f"node long, v {kind}")


def _window_edges(turn: np.ndarray, node: np.ndarray, vectors: np.ndarray, threshold: float, size: int, new: int) -> list:
    """Edges that connect verified pairs at most ``size`` apart, of which the second is among the last ``new``.

    Of pairs of vectors a spanning forest is enough; of a probe (below zero) and a vector every pair is given, the
    probe first, and of two probes none, so that probes connect nothing.
    """
    found, count = [], len(node)
    for start in range(0, count, 256):
        stop = min(count, start + 256)
        reach = min(count, stop + size)
        close = close_pairs(vectors[start:stop], vectors[start:reach], threshold)
        i, j = np.nonzero(close)
        apart = (j > i) & (j - i <= size) & (j + start >= count - new) & (turn[i + start] == turn[j + start])
        i, j = i[apart] + start, j[apart] + start
        real = (node[i] >= 0) & (node[j] >= 0)
        tree = np.arange(count)
        found += [(int(node[i[real][k]]), int(node[j[real][k]])) for k in _forest(i[real], j[real], tree)]
        mixed = (node[i] < 0) != (node[j] < 0)
        low, high = np.minimum(node[i], node[j])[mixed], np.maximum(node[i], node[j])[mixed]
        found += list(zip(low.tolist(), high.tolist(), strict=True))
    return found


def window_edges(keyed: DataFrame, threshold: float, window: int) -> DataFrame:
    """Edges ``a``, ``b`` of ``keyed`` (``node``, ``v``, ``keys``) over all passes of a round."""
    kind = keyed.schema["v"].dataType.simpleString()
    ordered = (
        keyed.select(F.posexplode("keys").alias("turn", "sort_key"), "node", "v")
        .repartitionByRange("turn", "sort_key", "node")
        .sortWithinPartitions("turn", "sort_key", "node")
        .withColumn("part", F.spark_partition_id())
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, node, vectors = np.empty(0, "int32"), np.empty(0, "int64"), np.empty((0, 0))
        last: pa.Table | None = None
        part, seen = None, 0
        for batch in batches:
            part = batch.column("part")[0].as_py()
            v = matrix(batch.column("v"))
            width = max(vectors.shape[1], v.shape[1])
            turn = np.concatenate([turn, batch.column("turn").to_numpy()])
            node = np.concatenate([node, batch.column("node").to_numpy()])
            vectors = np.concatenate([widened(vectors, width), widened(v, width)])
            edges = _window_edges(turn, node, vectors, threshold, window, batch.num_rows)
            yield _rows(edges, [], kind)
            turn, node, vectors = turn[-window:], node[-window:], vectors[-window:]
            own = pa.Table.from_batches([batch]).select(["turn", "node", "v"])
            if seen < window:
                head = own.slice(0, window - seen).to_pylist()
                yield _rows([], [(part, seen + k, *row.values()) for k, row in enumerate(head)], kind)
            last = own if last is None else pa.concat_tables([last, own])
            last = last.slice(max(0, last.num_rows - window))
            seen += batch.num_rows
        if part is not None:
            # The first rows went out already.
            tail = [(seen - last.num_rows + k, *row.values()) for k, row in enumerate(last.to_pylist())]
            yield _rows([], [(part, *row) for row in tail if row[0] >= window] + [(part, seen, None, None, None)], kind)

    schema = f"a long, b long, part int, place long, turn int, node long, v {kind}"
    out = written(ordered.select("turn", "node", "v", "part").mapInArrow(compared, schema), "windows")
    within = out.where("a is not null").select("a", "b")
    sizes = out.where("part is not null and node is null").select("part", "place").collect()
    near = _near_boundaries(sorted((r.part, r.place) for r in sizes), window)
    if not near:
        return within

    def across(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        width = max(map(len, group.v))
        vectors = np.array([np.pad(np.asarray(v, "float64"), (0, width - len(v))) for v in group.v])
        new = int((group["at"] >= group.boundary).sum())
        edges = _window_edges(group.turn.to_numpy(), group.node.to_numpy(), vectors, threshold, window, new)
        return pd.DataFrame(edges, columns=["a", "b"])

    parts = out.sparkSession.createDataFrame(near, "part int, start long, boundary long")
    beyond = (
        out.where("node is not null")
        .join(F.broadcast(parts), "part")
        .withColumn("at", F.col("start") + F.col("place"))
        .where(F.col("at").between(F.col("boundary") - window, F.col("boundary") + window - 1))
        .select("boundary", "at", "turn", "node", "v")
        .groupBy("boundary")
        .applyInPandas(across, "a long, b long")
    )
    return within.unionByName(beyond)


def _near_boundaries(sizes: list[tuple[int, int]], window: int) -> list[tuple[int, int, int]]:
    """(partition, place of its first row in the whole order, boundary) for each boundary within a window of it.

    ``sizes`` are the partitions that have rows, in order, with their numbers of rows: one entry per task.
    """
    starts = list(itertools.accumulate((n for _, n in sizes), initial=0))
    near, first = [], 1
    for (part, n), start in zip(sizes, starts, strict=False):
        while first < len(sizes) and starts[first] < start - window:
            first += 1
        for boundary in starts[first : len(sizes)]:
            if boundary > start + n + window:
                break
            near.append((part, start, boundary))
    return near


def _rows(edges: list, rows: list, kind: str) -> pa.RecordBatch:
    columns = ["a", "b", "part", "place", "turn", "node", "v"]
    item = pa.float32() if kind == "array<float>" else pa.float64()
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(item)]
    full = [(a, b, *[None] * 5) for a, b in edges] + [(None, None, *row) for row in rows]
    values = list(zip(*full, strict=True)) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, types, strict=True)], columns)


def grouped_nodes(nodes: DataFrame, threshold: float, window: int) -> DataFrame:
    """``node`` and ``label`` of the ``nodes`` (``node``, ``v``) that rounds of passes connect with others."""
    kind = nodes.schema["v"].dataType.simpleString()
    planted = written(probes(nodes, threshold, nodes.count()), "probes")
    wanted = planted.select(F.col("node").alias("probe"), (F.lit(-1) - F.col("node")).alias("source"))
    number, turn = wanted.count(), 0
    labels = met = None
    while True:

        def keyed(batches: Iterator[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = sort_keys(matrix(batch.column("v")), turn)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))], [*batch.schema.names, "keys"]
                )

        with_keys = nodes.unionByName(planted).mapInArrow(keyed, f"node long, v {kind}, keys array<long>")
        edges = written(window_edges(with_keys, threshold, window), "round")
        links = edges.where("a >= 0")
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = written(connected_components(links), "labels")
        hits = edges.where("a < 0").select(F.col("a").alias("probe"), F.col("b").alias("node")).distinct()
        met = written(hits if met is None else hits.unionByName(met).distinct(), "met")
        # A vector that no link was found for is a group of its own.
        of_hits = met.join(labels, "node", "left").select("probe", F.coalesce("label", "node").alias("label"))
        of_sources = wanted.join(labels, wanted.source == labels.node, "left").select(
            "probe", F.coalesce("label", "source").alias("label")
        )
        found = of_hits.join(of_sources, ["probe", "label"]).select("probe").distinct().count()
        if found >= PROBES_FOUND * number:
            return labels
        turn, window = turn + 1, max(window, min(WIDEST, window * WIDENING))


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """For each ``node`` of ``members`` (``label``, ``node``, ``n``, ``v``) the copies of other nodes of its label that
    it is linked to: all pairs, dealt out in blocks, and only their numbers returned."""
    sizes = members.groupBy("label").agg(F.count("*").alias("size"))
    dealt = (
        members.join(sizes, "label")
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy("label", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .agg(F.collect_list(F.struct("block", "node", "n", "v")).alias("members"))
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, links = [np.empty(0, "int64")], [np.empty(0, "int64")]
            lows, highs = batch.column("low").to_pylist(), batch.column("high").to_pylist()
            for group, low, high in zip(batch.column("members"), lows, highs, strict=True):
                inner = group.values
                v, block = matrix(inner.field("v")), inner.field("block").to_numpy()
                node, n = inner.field("node").to_numpy(), inner.field("n").to_numpy()
                a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
                close = close_pairs(v[a], v[b], threshold)
                if low == high:
                    np.fill_diagonal(close, False)
                else:
                    nodes.append(node[b])
                    links.append(close.T @ n[a])
                nodes.append(node[a])
                links.append(close @ n[b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(nodes)), pa.array(np.concatenate(links))], ["node", "links"]
            )

    return dealt.select("low", "high", "members").mapInArrow(counted, "node long, links long").groupBy("node").agg(
        F.sum("links").alias("links")
    )


def near_duplicate_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    window: int = WINDOW,
) -> DataFrame:
    """One row per row of ``table``: id, ``n_links``, ``component_id`` and ``kept``.

    Rows with a NULL id, or a vector that is NULL, zero or not finite, link with nothing: they have no links, are
    their own component and are kept. Vectors of different lengths are compared as if the shorter went on with
    zeros. Copies of a vector are one node, so that any number of them costs one comparison; rows with the same id
    are separate rows. Further columns are not read; no rows give no rows. ``window`` is that of the first round.
    """
    given = table.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("v"))
    takes_part = F.col("_id").isNotNull() & is_finite(F.col("v")) & F.exists("v", lambda x: x != 0)
    valid = given.where(takes_part)
    classes = written(
        valid.groupBy("v")
        .agg(F.min("_id").alias("first"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    labels = grouped_nodes(classes.select("node", "v"), threshold, window)
    members = labels.join(classes, "node")
    links = link_counts(members.select("label", "node", "n", "v"), threshold)
    smallest = members.groupBy("label").agg(F.min("first").alias("component_id"))
    found = members.select("label", "node").join(smallest, "label").join(links, "node").select("node", "component_id", "links")
    grouped = written(
        classes.join(found, "node", "left").select(
            F.col("v").alias("_v"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "first").alias("component_id"),
        ),
        "vector-groups",
    )
    linked = valid.join(grouped, F.col("v") == F.col("_v")).select("_id", "n_links", "component_id")
    alone = given.where(~takes_part).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
