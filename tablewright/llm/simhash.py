"""SimHash near-duplicates, with candidates by the pigeonring principle.

Two words of ``bits`` bits that differ in at most ``threshold`` are cut into ``segments`` on a ring. From some
segment on, every chain of ``l`` consecutive segments differs in at most ``l * threshold / segments`` bits. So the
first segments of that chain, as long as the budget is below one, are equal; the chain that follows, as long as
it is below two, has one differing bit at most, and one half of it is equal as well. Start, equal segments and
half are a key: words that share none differ too much. Words that share a key are held against the budgets of the
longer chains, then against the Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import id_type, rows, utf8, written
from tablewright.llm.components import connected_components

SEED = 42
#: Words compared at once in one group; a key with more is dealt out in pairs of blocks of about this size.
BLOCK = 2048


@dataclass(frozen=True)
class Ring:
    """How words are cut into segments, and the budgets of chains of these."""

    bits: int
    segments: int
    threshold: int
    halves: bool

    @property
    def width(self) -> int:
        return self.bits // self.segments

    def budget(self, chain: int) -> int:
        return chain * self.threshold // self.segments

    def longest(self, budget: int) -> int:
        """Segments of the longest chain with at most this budget."""
        return max(n for n in range(self.segments + 1) if self.budget(n) <= budget)

    @property
    def keys(self) -> list[tuple[int, int, int]]:
        """Start of a chain, and a mask of the bits, counted from it, that are equal: as two ranges joined."""
        equal, one = self.longest(0) * self.width, self.longest(1) * self.width
        middle = (equal + one) // 2
        halves = [(equal, middle), (middle, one)] if self.halves else [(equal, equal)]
        return [(start * self.width, equal, low << 8 | high) for start in range(self.segments) for low, high in halves]


#: 64 bits within 3: keys of 28 bits.
CONTRACT_RING = Ring(64, 8, 3, halves=True)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of the word shingles of a text, lower-cased in A-Z, repeats included."""
    words = text.lower().split()
    if len(words) < size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "uint64")


def _mixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Further 64 bits of the same shingles (the finalizer of SplitMix64 at another offset); turn 0 is the hash."""
    if not turn:
        return hashes
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def simhash(hashes: np.ndarray, turns: int = 1) -> list[int]:
    """Bits set in over half the hashes, as signed 64-bit numbers, one per turn."""
    found = []
    for turn in range(turns):
        ones = np.zeros(64, "int64")
        for start in range(0, len(hashes), 65_536):
            part = np.ascontiguousarray(_mixed(hashes[start : start + 65_536], turn))
            ones += np.unpackbits(part.view("uint8").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="uint32")
        found.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view("int64")[0]))
    return found


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, turns: int = 1) -> DataFrame:
    """``_id``, ``words`` (an array of ``turns`` fingerprints) and ``node``, the same as bytes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(shingle_hashes(text, shingle), turns) for _, text in rows([batch])]
            node = [np.array(words).tobytes() for words in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64())), pa.array(node, pa.binary())],
                ["_id", "words", "node"],
            )

    return docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("_text")).mapInArrow(
        hashed, f"_id {id_type(docs, id_col)}, words array<long>, node binary"
    )


def ring_keys(word: Column, ring: Ring, tag: int) -> list[Column]:
    """The keys of a word (a long of which ``ring.bits`` are used), told apart by ``tag`` and by their place."""
    full = (1 << ring.bits) - 1
    out = []
    for place, (start, equal, half) in enumerate(ring.keys):
        low, high = half >> 8, half & 255
        turned = word
        if start:
            turned = F.shiftleft(word, start).bitwiseOR(F.shiftrightunsigned(word, ring.bits - start))
            turned = turned.bitwiseAND(F.lit(full)) if ring.bits < 64 else turned
        key = F.shiftrightunsigned(turned, ring.bits - equal)
        if high > low:
            part = F.shiftrightunsigned(turned, ring.bits - high).bitwiseAND(F.lit((1 << (high - low)) - 1))
            key = F.shiftleft(key, high - low).bitwiseOR(part)
        out.append(key.bitwiseOR(F.lit((tag * len(ring.keys) + place) << 40)))
    return out


def near(a: np.ndarray, b: np.ndarray, key: int, ring: Ring, most: int) -> np.ndarray:
    """Which of ``a`` (n, words) lie close to ``b`` (m, words), candidates of the same key."""
    tag, place = divmod(key >> 40, len(ring.keys))
    start = ring.keys[place][0]
    per_word = 64 // ring.bits
    word, shift = divmod(tag, per_word)
    full = np.uint64((1 << ring.bits) - 1)

    def turned(x: np.ndarray) -> np.ndarray:
        x = (x[:, word] >> np.uint64(shift * ring.bits)) & full
        return ((x << np.uint64(start)) | (x >> np.uint64(ring.bits - start))) & full if start else x

    differ = turned(a)[:, None] ^ turned(b)[None, :]
    kept = np.ones(differ.shape, bool)
    for budget in range(1, ring.threshold + 1):
        chain = ring.longest(budget) * ring.width
        kept &= np.bitwise_count(differ >> np.uint64(ring.bits - chain)) <= budget
    i, j = np.nonzero(kept)
    if a.shape[1] > 1:
        close = np.bitwise_count(a[i] ^ b[j]).sum(1, dtype="int64") <= most
        i, j = i[close], j[close]
    return np.stack([i, j])


def _forest(i: np.ndarray, j: np.ndarray, tree: np.ndarray) -> Iterator[int]:
    """Where the pairs join what was not joined before; ``tree`` (a root for each member) is brought up to date."""

    def root(x: int) -> int:
        while tree[x] != x:
            x = tree[x]
        return x

    places = np.arange(len(i))
    while True:
        places = places[tree[i[places]] != tree[j[places]]]
        if not len(places):
            return
        for at in places[np.unique(tree[j[places]], return_index=True)[1]]:
            a, b = root(i[at]), root(j[at])
            if a != b:
                tree[max(a, b)] = min(a, b)
                yield at
        while (tree != tree[tree]).any():
            tree[:] = tree[tree]


def links(nodes: DataFrame, ring: Ring, words: int, indexed: int, most: int) -> DataFrame:
    """Edges ``a``, ``b`` (binary, the words of a node) that connect what lies close: a spanning forest per key.

    ``nodes`` has distinct arrays ``words``; the first ``indexed`` parts of ``ring.bits`` bits are looked up. Every
    edge is a pair within the ring's threshold in one part and within ``most`` bits in all.
    """
    per_word = 64 // ring.bits
    keys = []
    for tag in range(indexed):
        word = F.col("words")[tag // per_word]
        if ring.bits < 64:
            word = F.shiftrightunsigned(word, tag % per_word * ring.bits).bitwiseAND(F.lit((1 << ring.bits) - 1))
        keys += ring_keys(word, ring, tag)
    keyed = nodes.select(F.explode(F.array(*keys)).alias("key"), "words")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (
        # By merge: Spark takes the exploded keys for no larger than the compressed file of the nodes, and broadcasts them.
        keyed.hint("merge")
        .join(counts, "key")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("words"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .agg(F.collect_list(F.struct("block", "words")).alias("members"))
        .where(F.size("members") > 1)
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            members = batch.column("members")
            ends = members.offsets.to_numpy()
            inner = members.values
            all_words = inner.field("words").values.to_numpy().view("uint64").reshape(-1, words)
            block = inner.field("block").to_numpy()
            for at, (key, low, high) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("key", "low", "high")), strict=True)
            ):
                own = slice(ends[at], ends[at + 1])
                vectors, side = all_words[own], block[own]
                a = vectors[side == low]
                b = a if low == high else vectors[side == high]
                shift = 0 if low == high else len(a)
                tree = np.arange(shift + len(b))
                for start in range(0, len(a), 256):
                    i, j = near(a[start : start + 256], b, key, ring, most)
                    i = i + start
                    if low == high:
                        i, j = i[i < j], j[i < j]
                    for pair in _forest(i, j + shift, tree):
                        found.append((a[i[pair]].tobytes(), b[j[pair]].tobytes()))
            left, right = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    return dealt.mapInArrow(compared, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable.

    Fingerprints that differ in 3 of 64 bits or fewer are linked. A NULL or empty text, or one of white space
    alone, has fingerprint zero and is linked like any other; rows with the same id keep a row each. A NULL id is
    larger than any other. Further columns are not read; no rows give no rows.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(prints.groupBy("words", "node").agg(F.min("_id").alias("_first")), "nodes")
    edges = links(nodes, CONTRACT_RING, words=1, indexed=1, most=CONTRACT_RING.threshold)
    return prints.join(_grouped(nodes, edges), "node").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex(F.col("words")[0]), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row of ``docs``, with all its columns, of each group of ``near_duplicates``: that with the smallest id.

    NULL and empty texts, and those of white space alone, are one group. Of rows with the same id and text any one
    stays; of those with the same id and different texts in one group the one whose SHA-256 is the smallest. A NULL
    id counts as the largest. No rows give no rows.
    """
    given = F.col(id_col)
    digest = F.sha2(utf8(F.col(text_col)), 256)
    key = F.struct(given.isNull().alias("none"), given.alias("id"), digest.alias("digest"))
    found = near_duplicates(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), "_key", "_text", shingle)
    kept = found.select(F.col("component_id.id").alias("_id"), F.col("component_id.digest").alias("_digest")).distinct()
    marked = docs.withColumn("_own_digest", digest)
    same = marked[id_col].eqNullSafe(kept["_id"]) & (F.col("_own_digest") == kept["_digest"])
    copies = Window.partitionBy(id_col, "_own_digest").orderBy(F.lit(0))
    return (
        marked.join(kept, same, "left_semi")
        .withColumn("_copy", F.row_number().over(copies))
        .where("_copy = 1")
        .drop("_copy", "_own_digest")
    )


def _grouped(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node`` and ``component_id`` of every node, written."""
    labelled = nodes.join(connected_components(edges), "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("_first").alias("component_id"))
    return written(labelled.join(smallest, "label").select("node", "component_id"), "groups")
