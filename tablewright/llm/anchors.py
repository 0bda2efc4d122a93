"""Codes of vectors, cut into parts, by k-means that is exact and passes over metric trees.

Tasks put their vectors into chunks. For every part position of a chunk the distinct parts become a metric tree, built
middle-out by the anchors hierarchy: about sqrt(m) anchors, each the point farthest from its anchor so far, take over
the points that are nearer to them, where the triangle inequality cannot rule that out; anchors' balls are then merged
upwards, and large ones split downwards in the same way. Balls cache the sum and the number of their parts.

An assignment goes down the trees with lists of codebook entries. A ball inherits its parent's list and strikes off the
entries that another one beats for every point within its radius. Once a single entry is left, the ball is owned as a
whole and its cached sum and number count; what reaches a leaf is compared exactly, in integers, with its list alone.
The trees do not depend on the codebooks: they are built once, written, and serve all rounds.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_type, written
from tablewright.llm.whitening import _matrix, whole_vectors

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Vectors in a chunk, and points in a leaf.
CHUNK, LEAF = 4096, 32
#: Bounds are compared with this much to spare, so that rounding strikes off no entry.
SLACK = 1e-9


@dataclass
class Balls:
    """Nodes of a tree in the order they are made; points of a node are those from ``start`` to ``stop``."""

    pivot: list = field(default_factory=list)
    radius: list = field(default_factory=list)
    sum: list = field(default_factory=list)
    count: list = field(default_factory=list)
    children: list = field(default_factory=list)
    points: list = field(default_factory=list)

    def add(self, pivot, radius, total, count, children, points) -> int:
        for name, value in (
            ("pivot", pivot), ("radius", radius), ("sum", total), ("count", count), ("children", children), ("points", points)
        ):
            getattr(self, name).append(value)
        return len(self.radius) - 1


def anchored(points: np.ndarray, anchors: int) -> np.ndarray:
    """The anchor, by number, that owns each of the distinct ``points``."""
    owner, far = np.zeros(len(points), int), np.sqrt(((points - points[0]) ** 2).sum(1))
    places = [0]
    while len(places) < anchors:
        new = int(far.argmax())
        if far[new] <= 0:
            break
        between = np.sqrt(((points[places] - points[new]) ** 2).sum(1))
        # A point closer to its anchor than half the way between the anchors stays.
        asked = np.flatnonzero(far >= between[owner] / 2)
        distance = np.sqrt(((points[asked] - points[new]) ** 2).sum(1))
        won = distance < far[asked]
        owner[asked[won]], far[asked[won]] = len(places), distance[won]
        places.append(new)
    return owner


def _merged(balls: Balls, nodes: list[int]) -> int:
    """One ball above ``nodes``: the two whose common ball is smallest are merged, again and again."""
    size = len(nodes)
    node, alive = list(nodes), np.ones(size, bool)
    centre, radius = np.array([balls.pivot[k] for k in nodes]), np.array([balls.radius[k] for k in nodes])
    weight = np.array([float(balls.count[k]) for k in nodes])

    def against(i: int) -> np.ndarray:
        apart = np.sqrt(((centre - centre[i]) ** 2).sum(1))
        share = weight / (weight + weight[i])
        out = np.maximum(apart * (1 - share) + radius, apart * share + radius[i])
        out[~alive] = np.inf
        out[i] = np.inf
        return out

    common = np.array([against(i) for i in range(size)])
    for _ in range(size - 1):
        i, j = divmod(int(common.argmin()), size)
        left, right, wide = node[i], node[j], float(common[i, j]) * (1 + 1e-12)
        count = balls.count[left] + balls.count[right]
        centre[i] = (centre[i] * weight[i] + centre[j] * weight[j]) / (weight[i] + weight[j])
        weight[i], radius[i] = weight[i] + weight[j], wide
        points = np.concatenate([balls.points[left], balls.points[right]])
        total = balls.sum[left] + balls.sum[right]
        node[i] = balls.add(centre[i].copy(), wide, total, count, (left, right), points)
        alive[j] = False
        common[j, :], common[:, j] = np.inf, np.inf
        common[i, :] = against(i)
        common[:, i] = common[i, :]
    return node[int(alive.argmax())]


def _middle_out(balls: Balls, points: np.ndarray, counts: np.ndarray, own: np.ndarray) -> int:
    """The node over the distinct points ``own``."""
    if len(own) > LEAF:
        owner = anchored(points[own], math.isqrt(len(own) - 1) + 1)
        return _merged(balls, [_middle_out(balls, points, counts, own[owner == k]) for k in range(owner.max() + 1)])
    mine, often = points[own], counts[own]
    total = (mine * often[:, None]).sum(0)
    pivot = total / often.sum()
    radius = float(np.sqrt(((mine - pivot) ** 2).sum(1)).max()) * (1 + 1e-12)
    return balls.add(pivot, radius, total, int(often.sum()), (), own)


def metric_tree(parts: np.ndarray) -> dict[str, np.ndarray]:
    """A metric tree over the rows of ``parts``, as arrays by node; node 0 is the root and children follow parents."""
    points, row, counts = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    balls = Balls()
    root = _middle_out(balls, points, counts, np.arange(len(points)))
    order, place = [root], 0
    while place < len(order):
        order += balls.children[order[place]]
        place += 1
    number = {node: k for k, node in enumerate(order)}
    first = np.array([number[balls.children[n][0]] if balls.children[n] else -1 for n in order])
    # Points are numbered as the root holds them; every node's are then a stretch.
    arranged = balls.points[root]
    position = np.empty(len(points), int)
    position[arranged] = np.arange(len(points))
    start = np.array([position[balls.points[n][0]] for n in order])
    return {
        "points": points[arranged],
        "counts": counts[arranged],
        "row": position[row.ravel()].astype("int32"),
        "pivot": np.array([balls.pivot[n] for n in order]),
        "radius": np.array([balls.radius[n] for n in order]),
        "sum": np.array([balls.sum[n] for n in order]),
        "count": np.array([balls.count[n] for n in order]),
        "first": first,
        "start": start,
        "stop": start + np.array([len(balls.points[n]) for n in order]),
    }


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches of these sizes: which stretch each element is in, and its place there."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def owners(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Who owns what: balls and their entries, and the points of leaves with several candidates and theirs.

    Returns three arrays with two columns each or less: (node, entry) of owned balls, and point numbers with entries.
    """
    # Of equal entries the first wins every tie, so the others are never candidates.
    candidates = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    nodes = np.zeros(1, int)
    at, entry = np.zeros(len(candidates), int), candidates
    owned, points, theirs = [], [], []
    while len(nodes):
        away = np.sqrt(((tree["pivot"][nodes[at]] - entries[entry]) ** 2).sum(1))
        radius, starts = tree["radius"][nodes][at], np.flatnonzero(np.diff(at, prepend=-1))
        reach = np.minimum.reduceat(away + radius, starts)[at]
        kept = away - radius <= reach + SLACK * (1 + reach)
        at, entry = at[kept], entry[kept]
        size = np.bincount(at, minlength=len(nodes))
        begin = np.cumsum(size) - size
        alone, leaf = size == 1, tree["first"][nodes] < 0
        owned.append(np.stack([nodes[alone], entry[begin[alone]]], axis=1))
        for k in np.flatnonzero(leaf & ~alone).tolist():
            own, listed = np.arange(tree["start"][nodes[k]], tree["stop"][nodes[k]]), entry[begin[k] : begin[k] + size[k]]
            points.append(np.repeat(own, len(listed)))
            theirs.append(np.tile(listed, len(own)))
        further = np.flatnonzero(~leaf & ~alone)
        children = np.repeat(further, 2)
        which, place = _spread(size[children])
        entry = entry[begin[children][which] + place]
        at, nodes = which, (tree["first"][nodes[further]][:, None] + np.arange(2)).ravel()
    none = np.zeros(0, int)
    point, listed = np.concatenate([none, *points]), np.concatenate([none, *theirs])
    if len(point):
        error = ((tree["points"][point] - entries[listed]) ** 2).sum(1)
        starts = np.flatnonzero(np.diff(point, prepend=-1))
        least = np.repeat(np.minimum.reduceat(error, starts), np.diff(starts, append=len(point)))
        tied = np.flatnonzero(error == least)
        # Candidates stand in order of their numbers: the first of the nearest.
        first = tied[np.flatnonzero(np.diff(point[tied], prepend=-1))]
        point, listed = point[first], listed[first]
    return np.concatenate(owned), point, listed


def entry_sums(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and numbers of the parts that are nearest to each entry."""
    balls, point, entry = owners(tree, entries)
    totals, numbers = np.zeros_like(entries), np.zeros(len(entries), "int64")
    np.add.at(totals, balls[:, 1], tree["sum"][balls[:, 0]])
    np.add.at(numbers, balls[:, 1], tree["count"][balls[:, 0]])
    np.add.at(totals, entry, tree["points"][point] * tree["counts"][point][:, None])
    np.add.at(numbers, entry, tree["counts"][point])
    return totals, numbers


def nearest_entries(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row that the tree was made of, and the squared distance."""
    balls, point, entry = owners(tree, entries)
    nearest = np.empty(len(tree["points"]), int)
    nearest[point] = entry
    for node, one in balls.tolist():
        nearest[tree["start"][node] : tree["stop"][node]] = one
    error = ((tree["points"] - entries[nearest]) ** 2).sum(1)
    return nearest[tree["row"]], error[tree["row"]]


def _chunked(vectors: DataFrame, parts: int, chunk: int) -> DataFrame:
    """Rows of up to ``chunk`` vectors: their ids and labels, and a tree for each part position."""
    schema = f"ids array<{id_type(vectors, 'id')}>, labels array<{id_type(vectors, 'label')}>, trees binary"

    def packed(ids: list, labels: list, blocks: list) -> pa.RecordBatch:
        x = np.concatenate(blocks)
        trees = [metric_tree(part) for part in np.split(x, parts, axis=1)]
        columns = [pa.concat_arrays(ids), pa.concat_arrays(labels)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), c) for c in columns]
        return pa.RecordBatch.from_arrays([*lists, pa.array([pickle.dumps(trees)], pa.binary())], ["ids", "labels", "trees"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, blocks, held = [], [], [], 0
        for batch in batches:
            place = 0
            while place < batch.num_rows:
                part = batch.slice(place, chunk - held)
                ids.append(part.column(0))
                labels.append(part.column(1))
                blocks.append(part.column(2).flatten().to_numpy().reshape(part.num_rows, -1))
                held, place = held + part.num_rows, place + part.num_rows
                if held == chunk:
                    yield packed(ids, labels, blocks)
                    ids, labels, blocks, held = [], [], [], 0
        if held:
            yield packed(ids, labels, blocks)

    return vectors.select("id", "label", "x").mapInArrow(chunks, schema)


def _refined(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry becomes the floor of the mean of the parts nearest to it, unused entries stay."""
    parts, entries, width = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width + 1), "int64")
        for batch in batches:
            for trees in batch.column(0):
                for k, tree in enumerate(pickle.loads(trees.as_py())):
                    sums, numbers = entry_sums(tree, books[k])
                    totals[k, :, :width] += sums
                    totals[k, :, width] += numbers
        yield pa.RecordBatch.from_pydict({"place": np.arange(totals.size), "total": totals.ravel()})

    found = chunks.select("trees").mapInArrow(summed, "place long, total long")
    sums = [0] * (parts * entries * (width + 1))
    for r in found.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        sums[r.place] = int(r.total)
    out = books.copy()
    for row in range(parts * entries):
        *totals, number = sums[row * (width + 1) : (row + 1) * (width + 1)]
        if number:
            out[row // entries, row % entries] = [t // number for t in totals]
    return out


def _coded(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """``id``, ``label``, ``code`` and ``error`` of every vector."""
    fields = {f.name: f.dataType.elementType.simpleString() for f in chunks.schema if f.name != "trees"}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = [nearest_entries(t, books[k]) for k, t in enumerate(pickle.loads(batch.column(2)[row].as_py()))]
                digits = np.stack([nearest for nearest, _ in found], axis=1).astype("uint8")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[row].values,
                        batch.column(1)[row].values,
                        pa.array([code.tobytes().hex() for code in digits], pa.string()),
                        pa.array(sum(error for _, error in found)),
                    ],
                    ["id", "label", "code", "error"],
                )

    return chunks.mapInArrow(coded, f"id {fields['ids']}, label {fields['labels']}, code string, error long")


def vector_codes(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per finite vector: ``id_col``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Components become ``floor(256 * x)``; vectors are cut into ``parts`` equal parts, each coded by the nearest of at most
    256 ``entries``. Codebooks start as the parts of the vectors with the smallest ids and are refined ``rounds`` times.
    ``label_error`` adds up ``error`` over rows of equal label, NULLs together.

    Vectors that are NULL or hold NULL or non-finite components are left out; shorter ones, and widths that cannot be cut
    evenly, go on with zeros. Repeated rows are all returned and all count. Rows of equal id start codebooks in the order of
    their vectors, NULL ids last; fewer vectors than entries give smaller codebooks, none give no rows. Components so
    large that sums of squares do not fit a long are an error. Columns besides the three do not matter.
    """
    plain = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    vectors = whole_vectors(plain, "v", SCALE, 0).drop("v")
    seeds = vectors.orderBy(F.col("id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    schema = f"`{id_col}` {id_type(table, id_col)}, code string, error long, label_error long, codebooks_sha256 string"
    if not seeds:
        return table.sparkSession.createDataFrame([], schema)
    width = -(-max(1, len(seeds[0].x)) // parts) * parts
    missing = width - len(seeds[0].x)
    largest = math.isqrt((1 << 63) // width) // 2
    too_large = F.raise_error(F.lit(f"a component times {SCALE} is beyond {largest}")).cast("array<long>")
    fits = F.forall("x", lambda c: F.abs(c) <= largest)
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), missing))
    chunks = written(_chunked(vectors.withColumn("x", F.when(fits, padded).otherwise(too_large)), parts, chunk), "trees")
    books = np.array([np.split(np.array([*r.x, *[0] * missing], "int64"), parts) for r in seeds]).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _refined(chunks, books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = written(_coded(chunks, books), "codes")
    # The sums are written, so that the join has a plain shuffle on both sides and a frequent label's rows can be split.
    sums = written(codes.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")), "label-errors")
    joined = codes.join(sums, F.col("label").eqNullSafe(F.col("l")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
