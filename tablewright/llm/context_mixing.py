"""A language model by online logistic context mixing over every token of a text.

A token (a word, lower-cased in A-Z, or the text's end) is a sequence of bits: its place in a Huffman tree of the
training texts' most frequent words, an end, and one leaf for all other words. Every bit of every token is predicted
by its place in the tree alone, by two hashed contexts that cross words (the word before, the two words before) with
counts over all training texts, and by three contexts of the text so far (any word, the word before, the two before).
Each prediction starts from the one of the next shorter context; a logistic mixer combines them by weights that a gate
(how often the contexts were seen) selects and that are learned online over all training texts, each text predicted
without its own counts. A word of the last leaf is new to the text or not, a bit that is mixed and refined within the
text; a new one is spelled bit by bit by the hashed contexts of its bytes (``mixing_lm``), another one is chosen by its
frequency among those of the text so far. All choices are exclusive, so the probabilities of all texts add up to no
more than one.

Spark counts the words, turns each text into numbers once, gathers the contexts' counts from all training texts, fits
the weights in shards that the texts alone decide and spells every word without a place once. Counts and weights are
added up as whole numbers: partitions do not change a score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import mixing_lm
from tablewright.llm.common import id_remainder, id_type, utf8, written
from tablewright.llm.mixing_lm import KEY_BYTES, MULTIPLIERS, Totals, words_of

#: Words with a place in the tree: the most frequent ones of the training texts that occur twice, of KEY_BYTES at most.
CODED = 131_072
#: Of the other words, so many are looked up without a join; this affects speed alone.
TABLE_ENTRIES = 65_536
#: Hashed contexts: the word before, the two words before; slots of either, by the number of training tokens.
HASHED = 2
SLOT_BITS = (14, 22)
#: Predictions: the place alone, the hashed contexts, those of the text so far.
INPUTS = 1 + HASHED + 3
#: How many observations the prediction of the next shorter context is worth.
PRIOR, SURE = np.float32(0.5), np.float32(1e-6)
STRETCH = 12.0
#: The gate: how often either hashed context and the word before in this text were seen.
GATES = 4 * 4 * 3
#: Training tokens, on average, from which the mixer learns in one go; tokens between two changes of its weights.
SHARD_TOKENS = 1 << 19
MINIBATCH = 1 << 15
WEIGHTS = (-1.0, 2.0)
#: Bits whose errors are added up in one go.
FLUSH = 1 << 17
#: Of these, as many of one gate are worked through abreast.
COLUMNS = 1 << 13
#: Steps to one in which weights are added up.
STEPS = 1 << 32
#: Tokens that are worked through abreast, and bytes of texts that are numbered in one go.
ABREAST = 1 << 15
SLICE = 1 << 22


class Tree(NamedTuple):
    """Per leaf its code (from the highest bit on) and length; per node its children (leaves: below 0) and the chance
    of bit 1."""

    code: np.ndarray
    length: np.ndarray
    child: np.ndarray
    chance: np.ndarray

    @property
    def root(self) -> int:
        return len(self.child) - 1


def huffman(counts: list[int]) -> Tree:
    """Two leaves at least; equal counts by number, so that the tree is the same for the same counts."""
    leaves = len(counts)
    heap = [(n, k) for k, n in enumerate(counts)]
    heapq.heapify(heap)
    child, own = np.zeros((leaves - 1, 2), "int32"), np.zeros((leaves - 1, 2))
    for node in range(leaves - 1):
        (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
        child[node], own[node] = [k - leaves if k >= leaves else -1 - k for k in (a, b)], (n, m)
        heapq.heappush(heap, (n + m, leaves + node))
    codes, lengths = [0] * (leaves - 1), [0] * (leaves - 1)
    code, length = np.zeros(leaves, "uint64"), np.zeros(leaves, "uint8")
    for node in range(leaves - 2, -1, -1):
        for bit, k in enumerate(child[node].tolist()):
            value, size = codes[node] << 1 | bit, lengths[node] + 1
            if k >= 0:
                codes[k], lengths[k] = value, size
            else:
                code[-1 - k], length[-1 - k] = value << (64 - size), size
    return Tree(code, length, child, ((own[:, 1] + 0.5) / (own.sum(1) + 1)).astype("float32"))


def in_order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the numbers (0 or more) stand, equal ones in their order; and the numbers in order."""
    shift = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + shift < 64:
        ordered = np.sort(key << shift | np.arange(len(key)))
        return ordered & (1 << shift) - 1, ordered >> shift
    order = np.argsort(key, kind="stable")
    return order, key.take(order)


class History:
    """Of tokens with the same key: how many before each began with the same bits, and (``whole``) how many do in all.

    ``step`` goes one place down the tree: those with a zero come first, then those with a one, in the order that they
    had, so that tokens with the same bits stay together. Tokens that are alone have none before them and are left out.
    """

    def __init__(self, key: np.ndarray, place: np.ndarray, whole: bool) -> None:
        order, ordered = in_order(key)
        self.whole = whole
        self._count(place.take(order), ordered, 0, len(key))

    def _count(self, tokens: np.ndarray, group: np.ndarray, border: int, n: int) -> None:
        """``border``: where a group begins in any case; ``n``: tokens that are in the tree still."""
        self.before, self.every = np.zeros(n, "float32"), np.ones(n, "float32") if self.whole else None
        first = np.ones(len(tokens) + 1, bool)
        np.not_equal(group[1:], group[:-1], out=first[1:-1])
        first[border] = True
        shared = ~(first[:-1] & first[1:])
        self.tokens = tokens.compress(shared)
        starts = np.flatnonzero(first[:-1].compress(shared))
        sizes = np.diff(starts, append=len(self.tokens))
        self.group = starts.repeat(sizes)
        self.before[self.tokens] = np.arange(len(self.tokens)) - self.group
        if self.whole:
            self.every[self.tokens] = sizes.repeat(sizes)

    def step(self, one: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the tokens whose next bit is given (the first of those so far): how many are before each and in all, as
        they were and with that bit."""
        n, before, every = len(one), self.before, self.every
        active, own = self.tokens < n, one.take(self.tokens, mode="clip")
        zeros, ones = active & ~own, active & own
        tokens = self.tokens.compress(zeros)
        group = np.concatenate([self.group.compress(zeros), self.group.compress(ones)])
        self._count(np.concatenate([tokens, self.tokens.compress(ones)]), group, len(tokens), n)
        return before[:n], self.before, every[:n] if self.whole else None, self.every


class Stream(NamedTuple):
    """Tokens of some texts, those with long codes first: hashed contexts, codes; and the groups of each history."""

    order: np.ndarray
    text: np.ndarray
    symbol: np.ndarray
    contexts: list[np.ndarray]
    keys: list[np.ndarray]


def stream(texts: list[np.ndarray], tree: Tree) -> Stream:
    sizes = np.fromiter(map(len, texts), "int64", len(texts))
    symbol, text = np.concatenate(texts).astype("int64"), np.repeat(np.arange(len(texts)), sizes)
    first, none = np.cumsum(sizes) - sizes, len(tree.code)
    before = np.concatenate([[none], symbol[:-1]])
    before[first] = none
    second = np.concatenate([[none], before[:-1]])
    second[first] = none
    pair = text * (none + 1) + before
    # Those after the same word side by side: they share slots.
    order, _ = in_order((255 - tree.length[symbol].astype("int64")) * (none + 1) + before)
    at, of = in_order(pair)
    group = np.empty(len(pair), "int64")
    group[at] = np.cumsum(np.diff(of, prepend=-1) != 0)
    one = (before.astype("uint64") + np.uint64(1)) * MULTIPLIERS[0]
    two = (one ^ second.astype("uint64")) * MULTIPLIERS[2]
    return Stream(order, text, symbol, [one[order], two[order]], [text, group, group * (none + 1) + second])


def walked(tokens: Stream, tree: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place by place: the nodes of the tokens whose codes are that long, and their bits."""
    symbol = tokens.symbol.take(tokens.order)
    code, length = tree.code.take(symbol), tree.length.take(symbol)
    node, child = np.full(len(symbol), tree.root), tree.child.ravel()
    for n in len(symbol) - np.cumsum(np.bincount(length))[:-1]:
        code, node = code[:n], node[:n]
        bit = (code >> np.uint64(63)).view("int64")
        yield node, bit
        code, node = code << np.uint64(1), child.take(2 * node + bit)


def slots_of(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    mixed = (context ^ node.astype("uint64") * MULTIPLIERS[1]) * MULTIPLIERS[0]
    return (mixed >> np.uint64(64 - bits)).view("int64")


def gather(texts: list[np.ndarray], tree: Tree, counts: np.ndarray) -> None:
    """Add the texts' bits to the counts (context, 2 * slot + bit)."""
    bits = (counts.shape[1] // 2).bit_length() - 1
    tokens, one = stream(texts, tree), np.int32(1)
    for node, bit in walked(tokens, tree):
        for context, own in zip(tokens.contexts, counts, strict=True):
            np.add.at(own, 2 * slots_of(context[: len(node)], node, bits) + bit, one)


def _smoothed(zeros: np.ndarray, ones: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretched prediction from counts that start from a shorter context's chance; and its own chance."""
    chance = np.maximum(chance, SURE)
    np.minimum(chance, 1 - SURE, out=chance)
    chance *= PRIOR
    ones = ones + chance
    zeros = zeros + np.subtract(PRIOR, chance, out=chance)
    value = ones / zeros
    zeros += ones
    return np.log(value, out=value), np.divide(ones, zeros, out=zeros)


def _ones(every: np.ndarray, same: np.ndarray, one: np.ndarray) -> np.ndarray:
    """How many of all have a one, by how many have the same bit and whether it is one."""
    other = every - same
    return other + one * (same - other)


def _gates(one: np.ndarray, two: np.ndarray, own: np.ndarray) -> np.ndarray:
    gate = (two > 0).view("int8") + (two > 2) + (two > 15)
    gate = 4 * gate + (one > 0) + (one > 2) + (one > 15)
    return 3 * gate + (own > 0) + (own > 2)


def predictions(
    texts: list[np.ndarray], tree: Tree, table: np.ndarray, apart: bool
) -> tuple[Stream, Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]]:
    """Tokens, and place by place: stretched predictions, gates and bits; ``apart``: without the texts' own counts.

    ``table`` (context, slot) has a slot's zeros in the lower and its ones in the upper 16 bits.
    """
    tokens = stream(texts, tree)
    bits = table.shape[1].bit_length() - 1

    def each() -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        place = np.empty(len(tokens.order), "int64")
        place[tokens.order] = np.arange(len(place))
        histories = [History(key, place, apart and k > 0) for k, key in enumerate(tokens.keys)]
        stretched = np.log(tree.chance / (1 - tree.chance))
        for node, bit in walked(tokens, tree):
            n, one = len(node), bit.astype("float32")
            base = tree.chance.take(node)
            found, inputs, seen = [h.step(bit.astype(bool)) for h in histories], [stretched.take(node)], []
            chance = base
            for k, own in enumerate(table):
                pair = own.take(slots_of(tokens.contexts[k][:n], node, bits))
                zeros, ones = (pair & np.uint32(0xFFFF)).astype("float32"), (pair >> np.uint32(16)).astype("float32")
                if apart:
                    *_, every, same = found[1 + k]
                    own_ones = _ones(every, same, one)
                    zeros, ones = np.maximum(zeros - (every - own_ones), 0), np.maximum(ones - own_ones, 0)
                seen.append(zeros + ones)
                value, chance = _smoothed(zeros, ones, chance)
                inputs.append(value)
            chance = base
            for before, same, *_ in found:
                ones = _ones(before, same, one)
                value, chance = _smoothed(before - ones, ones, chance)
                inputs.append(value)
            seen.append(found[1][0])
            yield inputs, _gates(*seen), bit

    return tokens, each()


def _logistic(total: np.ndarray) -> np.ndarray:
    """In place: 1 / (1 + exp(-total)), stretched no further than ``STRETCH``."""
    np.maximum(total, -STRETCH, out=total)
    np.minimum(total, STRETCH, out=total)
    np.exp(np.negative(total, out=total), out=total)
    total += 1
    return np.divide(1, total, out=total)


def _mixed(inputs: list[np.ndarray], gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The chance of bit 1; weights (input, gate)."""
    weights = weights.astype("float32")
    gate = gate.astype("int64")
    total = weights[0].take(gate) * inputs[0]
    for own, value in zip(weights[1:], inputs[1:], strict=True):
        total += own.take(gate) * value
    return _logistic(total.astype("float64"))


def even_weights() -> np.ndarray:
    """The longest context over all texts and the longest of the text itself, by halves."""
    weights = np.zeros((INPUTS, GATES))
    weights[HASHED] = weights[-1] = 0.5
    return weights


def batches_of(texts: list[np.ndarray], size: int) -> Iterator[list[np.ndarray]]:
    """Whole texts, together of about that many tokens."""
    ends = np.cumsum([len(text) for text in texts])
    start = 0
    while start < len(texts):
        stop = 1 + int(np.searchsorted(ends, size + (ends[start - 1] if start else 0)))
        yield texts[start:stop]
        start = stop


def learn(texts: list[np.ndarray], copies: np.ndarray, tree: Tree, table: np.ndarray) -> np.ndarray:
    """One online pass over texts, each of which stands for so many copies: after each batch the weights of a gate
    make a Newton step by the error in the batch and the curvature of all so far."""
    weights, curve, start = even_weights(), np.tile(np.eye(INPUTS), (GATES, 1, 1)), 0
    for part in batches_of(texts, MINIBATCH):
        pull, waiting, size = np.zeros((GATES, INPUTS)), [], 0
        tokens, each = predictions(part, tree, table, True)
        times = copies[start : start + len(part)].astype("float64")[tokens.text[tokens.order]]
        start += len(part)
        for found in each:
            size += len(found[1])
            waiting.append((*found, times[: len(found[1])]))
            if size > FLUSH:
                _learned(waiting, weights, pull, curve)
                waiting, size = [], 0
        _learned(waiting, weights, pull, curve)
        weights = np.clip(weights + np.linalg.solve(curve, pull[..., None])[..., 0].T, *WEIGHTS)
    return weights


def _learned(waiting: list[tuple], weights: np.ndarray, pull: np.ndarray, curve: np.ndarray) -> None:
    """Add error and curvature of some bits, gate by gate."""
    if not waiting:
        return
    gate = np.concatenate([gate for _, gate, *_ in waiting])
    order = np.argsort(gate, kind="stable")
    inputs = np.empty((INPUTS, len(gate)))
    for row, values in zip(inputs, zip(*(own for own, *_ in waiting), strict=True), strict=True):
        row[:] = np.concatenate(values).take(order)
    bit = np.concatenate([bit for *_, bit, _ in waiting]).take(order)
    times = np.concatenate([times for *_, times in waiting]).take(order)
    edges = np.concatenate([[0], np.cumsum(np.bincount(gate, minlength=GATES))])
    for k in np.flatnonzero(np.diff(edges)).tolist():
        for start in range(edges[k], edges[k + 1], COLUMNS):
            own = slice(start, min(start + COLUMNS, edges[k + 1]))
            values = inputs[:, own]
            chance = _logistic(weights[:, k] @ values)
            pull[k] += values @ (times[own] * (bit[own] - chance))
            values *= np.sqrt(times[own] * chance * (1 - chance))
            curve[k] += values @ values.T


def costs(texts: list[np.ndarray], tree: Tree, table: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text's places in the tree."""
    out = []
    for part in batches_of(texts, ABREAST):
        tokens, each = predictions(part, tree, table, False)
        product = np.ones(len(tokens.order))
        for inputs, gate, bit in each:
            chance = _mixed(inputs, gate, weights)
            chance -= 1 - bit
            product[: len(bit)] *= np.abs(chance, out=chance)
        logs = np.empty(len(product))
        logs[tokens.order] = np.log10(product)
        out.append(np.bincount(tokens.text, logs, len(part)))
    return np.concatenate(out) if out else np.empty(0)


def packed(counts: np.ndarray) -> np.ndarray:
    """Counts (context, slot, bit) as pairs of 16 bits; larger ones are halved together until they fit."""
    table = np.empty(counts.shape[:2], "uint32")
    for own, pairs in zip(table, counts, strict=True):
        top = pairs.max(1)
        large = np.flatnonzero(top > 0xFFFF)
        halvings = np.frexp(top[large].astype("float64"))[1] - 16
        own[:] = pairs[:, 0] & 0xFFFF | (pairs[:, 1] & 0xFFFF).astype("uint32") << np.uint32(16)
        fitting = (pairs[large] >> halvings[:, None]).astype("uint32")
        own[large] = fitting[:, 0] | fitting[:, 1] << np.uint32(16)
    return table


def _symbols(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "int32") for x in batch.column("symbols").to_pylist()]


def context_counts(texts: DataFrame, tree, tokens: int) -> np.ndarray:
    """The table of ``predictions`` over the training texts."""
    bits = min(max((4 * tokens).bit_length(), SLOT_BITS[0]), SLOT_BITS[1])

    def add(batch: pa.RecordBatch, table: np.ndarray) -> None:
        for part in batches_of(_symbols(batch), ABREAST):
            gather(part, tree.value, table)

    return packed(mixing_lm.counts_of(texts.where("_train").select("symbols"), (HASHED, 2 << bits), add))


def context_weights(texts: DataFrame, tree, table, tokens: int) -> np.ndarray:
    """The mean, by tokens, of what each shard of the training texts teaches the mixer online.

    Shards are dealt out and read by the hashes of the texts, copies of a text go as one with their number, and
    weights are added up as whole numbers, so the result does not depend on partitions.
    """

    def learned(group: pa.Table) -> pa.Table:
        each = list(zip(group["symbols"].to_pylist(), group["copies"].to_pylist(), strict=True))
        each.sort(key=lambda own: (xxhash.xxh64_intdigest(own[0]), own[0]))
        texts, copies = [np.frombuffer(x, "int32") for x, _ in each], np.array([n for _, n in each])
        steps = np.rint(learn(texts, copies, tree.value, table.value).ravel() * STEPS).astype("int64").tolist()
        size = int(copies @ np.array([len(text) for text in texts]))
        amounts = pa.array([str(step * size) for step in steps])
        return pa.table({"place": np.arange(len(steps), dtype="int32"), "amount": amounts, "size": [size] * len(steps)})

    distinct = texts.where("_train").groupBy("symbols").agg(F.count("*").alias("copies"))
    shard = F.pmod(F.xxhash64("symbols"), F.lit(1 + tokens // SHARD_TOKENS))
    each = distinct.withColumn("shard", shard).groupBy("shard").applyInArrow(learned, "place int, amount string, size long")
    found = each.groupBy("place").agg(
        F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount"), F.sum("size").alias("size")
    ).toArrow()
    weights = even_weights()
    for place, amount, size in zip(*(found[k].to_pylist() for k in ("place", "amount", "size")), strict=True):
        weights.ravel()[place] = int(amount) / size / STEPS
    return weights


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = (7, 2)
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``
    (log10 probabilities, by word frequencies alone and by the model) and ``bits_per_byte`` (of the text's UTF-8 bytes).

    Learns from the rows whose ``crc32(id as text) mod held_out[0]`` is not ``held_out[1]``. A NULL or empty text is
    its end alone. Rows with the same id are texts of their own; further columns are not read. Without training rows
    every bit starts from an even chance.
    """
    texts = docs.select(
        F.col(id_col).alias("_id"),
        (id_remainder(F.col(id_col), held_out[0]) != held_out[1]).alias("_train"),
        utf8(F.col(text_col)).alias("_text"),
    )
    words = mixing_lm.count_words(texts)
    trained = texts.where("_train").count()
    row = words.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
        F.count_if(F.col("count") > 0).alias("v"),
        F.coalesce(F.count_if(F.col("count") == 1), F.lit(0)).alias("once"),
    ).first()
    totals = Totals(row.n + trained, row.v + (trained > 0), row.once, trained)
    context = docs.sparkSession.sparkContext

    fit = (F.length("word") <= KEY_BYTES) & (F.col("count") > 1)
    coded = words.where(fit).orderBy(F.desc("count"), "word").limit(CODED).select("word", "count").toArrow()
    counts = coded["count"].to_pylist()
    others = words
    if counts:
        count, least, last = F.col("count"), counts[-1], F.lit(coded["word"][-1].as_py())
        others = words.where(~(fit & ((count > least) | (count == least) & (F.col("word") <= last))))
    bits = context.broadcast(mixing_lm.bit_counts(words))
    spelled = mixing_lm.spell(others, bits, mixing_lm.mixing_weights(words, totals.once, bits))
    vocabulary = written(spelled, "spelled")
    bits.unpersist()
    looked = (
        vocabulary.where(F.length("word") <= KEY_BYTES)
        .orderBy(F.desc("every"), "word")
        .limit(TABLE_ENTRIES)
        .select("word", "count", "spelling")
        .toArrow()
    )
    known = context.broadcast(
        (
            pa.concat_arrays([coded["word"].combine_chunks(), looked["word"].combine_chunks()]),
            np.array(counts + looked["count"].to_pylist(), "int64"),
            looked["spelling"].to_numpy(),
        )
    )
    parts = written(_numbered(texts, id_type(docs, id_col), known, totals), "texts")
    known.unpersist()
    # One more than counted: a word without a place, and an end, may come up in any case.
    tree = context.broadcast(huffman([*counts, row.n - sum(counts) + 1, trained + 1]))
    table = context.broadcast(context_counts(parts, tree, totals.tokens))
    placed = _placed(parts, tree, table, context_weights(parts, tree, table, totals.tokens))
    rare = parts.select("_row", F.explode("rare").alias("r")).select("_row", "r.*")
    found = (
        rare.join(vocabulary, "word")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * mixing_lm.column_base(totals)).alias("more_base"),
            F.sum("spelling").alias("more"),
            F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        )
    )
    none = F.lit(0)
    score = F.col("score") + F.coalesce("more", none)
    return placed.join(found, "_row", "left").select(
        F.col("_id").alias(id_col),
        (~F.col("_train")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", none)).alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", none)).alias("base_score"),
        score.alias("score"),
        F.when(F.col("n_bytes") > 0, -score * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _numbered(texts: DataFrame, kind: str, known, totals: Totals) -> DataFrame:
    """Per text: its tokens as leaves of the tree, what the broadcast table and the text itself say about words without
    a place, and those that the table lacks."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, count, spelling = known.value
        base, coded = np.append(totals.base(count), 0.0), len(count) - len(spelling)
        listed, spelling = np.append(count > 0, False), np.append(spelling, 0.0)
        end_base = float(totals.base(np.array(totals.texts)))
        for batch in mixing_lm.in_slices(batches, "_text", SLICE):
            words, sizes = mixing_lm.split_words(batch.column("_text"))
            texts, ends = len(sizes), np.cumsum(sizes)
            text = np.repeat(np.arange(texts), sizes)
            place = pc.index_in(words, entries).fill_null(-1).to_numpy().astype("int64")

            def summed(values: np.ndarray, text: np.ndarray) -> np.ndarray:
                return np.bincount(text, values, texts).astype("float64")  # noqa: B023

            symbols = np.full(len(words) + texts, coded + 1, "int32")
            leaf = np.minimum(place.view("uint64"), np.uint64(coded)).astype("int32")
            symbols[np.arange(len(words)) + text] = leaf
            offsets = np.concatenate([[0], 4 * (ends + np.arange(1, texts + 1))]).astype("int32")

            # The words without a place, and each of them in a text once.
            apart = np.flatnonzero(leaf == coded)
            others, owner = words.take(pa.array(apart)), text[apart]
            number = others.dictionary_encode()
            order, ordered = in_order(owner * len(number.dictionary) + number.indices.to_numpy().astype("int64"))
            starts = np.flatnonzero(np.diff(ordered, prepend=-1))
            first, times = order[starts], np.diff(starts, append=len(order))
            at, whose = place[apart[first]], owner[first]
            new = np.zeros(len(apart), bool)
            new[first] = True
            found = np.bincount(owner, minlength=texts)
            so_far = np.arange(len(apart)) - np.repeat(np.cumsum(found) - found, found)
            # A word's tokens have 0, 1, 2 and so on of it before them: the product is a factorial.
            factorials = np.cumsum(np.log10(np.maximum(1, np.arange(times.max(initial=1)))))
            score = summed(spelling[np.maximum(at - coded, -1)] + factorials[times - 1], whose)
            score -= summed(np.log10(np.where(new, 1, so_far)), owner)
            score += mixing_lm.novelty_cost(np.split(new, np.cumsum(found)[:-1]))

            rare = at < 0
            missing = pa.StructArray.from_arrays(
                [others.take(pa.array(first[rare])), pa.array(times[rare])], ["word", "times"]
            )
            rare_ends = np.cumsum(np.bincount(whose[rare], minlength=texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes + 1, pa.int64()),
                    pa.array(summed(listed[place], text).astype("int64") + (totals.texts > 0)),
                    pa.array(summed(base[place], text) + end_base),
                    pa.array(score),
                    pc.binary_length(batch.column(2)).cast(pa.int64()),
                    pa.Array.from_buffers(pa.binary(), texts, [None, pa.py_buffer(offsets), pa.py_buffer(symbols)]),
                    pa.ListArray.from_arrays(pa.array(np.append(0, rare_ends), pa.int32()), missing),
                ],
                ["_id", "_train", "n_tokens", "n_known", "base_score", "score", "n_bytes", "symbols", "rare"],
            )

    return texts.mapInArrow(
        numbered,
        f"_id {kind}, _train boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, "
        "symbols binary, rare array<struct<word:binary,times:long>>",
    ).withColumn("_row", F.monotonically_increasing_id())


def _placed(parts: DataFrame, tree, table, weights: np.ndarray) -> DataFrame:
    """Add to the score what the tokens' places in the tree cost."""
    kept = parts.drop("rare")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = batch.column("score").to_numpy() + costs(_symbols(batch), tree.value, table.value, weights)
            yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(score)).drop_columns(["symbols"])

    return kept.mapInArrow(placed, kept.drop("symbols").schema)
