"""A language model by online logistic context mixing.

A text is a sequence of words (lower-cased in A-Z) and one end. A word that training texts lack is spelled bit by
bit: hashed contexts (its last 1, 2, 3, 4 and 6 bytes) each predict the next bit from counts over the corpus, and a
logistic mixer combines the predictions by weights that a gate (how well the context is known, which bit of the byte)
selects and that are learned online. A word of the training texts has its frequency there instead. Whether the next
token is new is a bit, too: predictors in the contexts of the text so far are mixed by weights that are refined
online within the text, starting afresh in each. A new word is none of the most frequent ones that the text has had,
so these (``LEAVING``, a part of the model) leave it their share; one that is not new is chosen by its frequency in
the text so far. All choices are exclusive, so the probabilities of all texts add up to no more than one.

Spark counts the words over the training texts, gathers the bit counts from all of them, fits the weights, and
spells every new word once. Texts then need a lookup per word: frequent words by a bounded table that is broadcast,
the others by a join. Weights are learned in shards of words that the words alone decide, and added up exactly:
neither the partitioning nor the size of the table of frequent words changes a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress, repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_remainder, id_type, rows, utf8, written

#: Bytes of the contexts, and slots of the table of either.
ORDERS = (1, 2, 3, 4, 6)
SLOT_BITS = 20
#: Counts travel in blocks of so many slots.
BLOCK_SLOTS = 8192
#: Longer words are spelled in pieces of so many bytes; only the last piece ends with the mark of a word's end.
PIECE = 48
MARK = 32
#: Words of the broadcast table, beside those that leave a share, and their largest size: 12 MB in all at most.
TABLE_ENTRIES = 131_072
KEY_BYTES = 48
#: Bytes of texts whose words are counted in one go.
SLICE = 1 << 25
#: The most frequent words of the training texts, of that size at most, that leave their share to new ones.
LEAVING = 32_768
#: Words, on average, from which the mixer learns in one go, and the steps to one in which its weights are added up.
SHARD_WORDS = 1 << 17
STEPS = 1 << 32
#: Words that the mixer sees before its weights change, and its rate.
MINIBATCH = 8192
RATE = 1.0
#: Words that are spelled, or whose bits are gathered, abreast.
SPELLED = 1 << 16
#: Predictions are stretched no further, and weights stay in this range.
STRETCH = 8.0
WEIGHTS = (-0.5, 2.0)
#: Texts that are worked through abreast.
ABREAST = 8192
#: The gate: how often a context of this order was seen, in steps of a factor of four, and which bit of a byte it is.
GATE_ORDER, LEVELS = 3, 6
GATES = LEVELS * 8
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], "uint64")


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """As ``words_of``: the words of all texts, one after the other, and how many each text has."""
    plain = pa.Array.from_buffers(pa.string(), len(texts), [None, *texts.buffers()[1:]], offset=texts.offset)
    found = pc.ascii_split_whitespace(pc.ascii_lower(plain))
    words, sizes = found.flatten().cast(pa.binary()), np.diff(found.offsets.to_numpy())
    filled = pc.binary_length(words).to_numpy() > 0
    if not filled.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes).compress(filled), minlength=len(sizes))
        words = words.filter(pa.array(filled))
    return words, sizes


def in_slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows with so many bytes at most in a binary column; a longer value is alone."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("int64"))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Bits(NamedTuple):
    """The same bit of many words, those with the same contexts and byte as one: which words, which of the ones each
    is, how many each stands for, slots per order (order, one), the bit, and its place in the byte."""

    words: np.ndarray
    one: np.ndarray
    times: np.ndarray
    slots: np.ndarray
    bit: np.ndarray
    place: int


def bits_of(words: list[bytes]) -> tuple[Iterator[Bits], np.ndarray, np.ndarray]:
    """The bits of words cut into pieces, abreast; with the word of each piece and the number of bytes."""
    marked = np.fromiter(map(len, words), "int64", len(words)) + 1
    letters = np.frombuffer(bytes([MARK]).join([*words, b""]), "uint8")
    cut = -(-marked // PIECE)
    owner = np.repeat(np.arange(len(words)), cut)
    lengths = np.full(len(owner), PIECE)
    lengths[np.cumsum(cut) - 1] = marked - PIECE * (cut - 1)
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    width = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(width), "left").tolist()

    def each() -> Iterator[Bits]:
        history = np.zeros(len(order), "uint64")
        masks = np.array([(1 << 8 * n) - 1 for n in ORDERS], "uint64")[:, None]
        salts = (np.arange(1, len(ORDERS) + 1, dtype="uint64") * MULTIPLIERS[2])[:, None]
        for j in range(width):
            n = active[j]
            key = history[:n] << np.uint64(8) | letters.take(starts[:n] + j).astype("uint64")
            history[:n] = key & masks[-1]
            key, one, times = np.unique(key, return_inverse=True, return_counts=True)
            letter = key & np.uint64(255)
            context = (key >> np.uint64(8) & masks) * MULTIPLIERS[0] + salts
            node = np.ones(len(key), "uint64")
            for place in range(8):
                slots = ((context ^ node * MULTIPLIERS[1]) * MULTIPLIERS[0]) >> np.uint64(64 - SLOT_BITS)
                bit = letter >> np.uint64(7 - place) & np.uint64(1)
                yield Bits(order[:n], one, times, slots.astype("int64"), bit.astype("int8"), place)
                node = node << np.uint64(1) | bit
        return

    return each(), owner, lengths


def _weight(counts: np.ndarray) -> np.ndarray:
    """What a word that occurs so often adds to a bit's count: 1, 2 from 2 on, 3 from 4 on, and so on."""
    return np.where(counts > 0, np.frexp(counts.astype("float64"))[1], 0).astype("int32")


def gather_bits(words: list[bytes], counts: np.ndarray, table: np.ndarray) -> None:
    """Add the words' bits to the counts (order, 2 * slot + bit)."""
    for start in range(0, len(words), SPELLED):
        bits, owner, _ = bits_of(words[start : start + SPELLED])
        weight = _weight(counts[start : start + SPELLED])[owner]
        for part in bits:
            own = np.bincount(part.one, weight[part.words], len(part.bit)).astype("int32")
            for order, at in zip(table, 2 * part.slots + part.bit, strict=True):
                np.add.at(order, at, own)


def _stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -STRETCH, STRETCH)


def _level(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.minimum(LEVELS - 1, np.log2(1 + zeros + ones) / 2)


def _predicted(table: np.ndarray | Prepared, part: Bits, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretched predictions (order, word) that the bit is 1, and the gate of each word; without the word's own count."""
    if isinstance(table, Prepared):
        at = 2 * part.slots + part.bit if own else part.slots
        values = np.stack([row.take(place) for row, place in zip(table.stretched, at, strict=True)])
        return values, table.level.take(at[GATE_ORDER]).astype("int64") * 8 + part.place
    pairs = np.stack([table[k][part.slots[k]] for k in range(len(ORDERS))]).astype("float32")
    pairs[:, np.arange(len(part.bit)), part.bit] -= own
    zeros, ones = np.maximum(pairs[..., 0], 0), np.maximum(pairs[..., 1], 0)
    known = _level(zeros[GATE_ORDER], ones[GATE_ORDER]).astype("int64")
    return _stretched(zeros, ones), known * 8 + part.place


def _weighted(stretched: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The mixed predictions, stretched; weights (gate, order)."""
    total = np.zeros(len(gate))
    for own, values in zip(np.ascontiguousarray(weights.T), stretched, strict=True):
        total += own.take(gate) * values
    return np.clip(total, -20, 20)


class Prepared(NamedTuple):
    """What ``_predicted`` makes of every slot (and, without a word's own count, of either bit)."""

    stretched: np.ndarray
    level: np.ndarray


def prepared(table: np.ndarray, own: int) -> Prepared:
    """For many words; ``own`` as it is in ``_predicted``."""
    width = 1 + bool(own)
    out = np.empty((len(ORDERS), table.shape[1], width), "float32")
    level = np.empty((table.shape[1], width), "int8")
    for k, counts in enumerate(table):
        for bit in range(width):
            zeros, ones = (np.maximum(counts[:, j].astype("float32") - own * (bit == j), 0) for j in (0, 1))
            out[k, :, bit] = _stretched(zeros, ones)
            if k == GATE_ORDER:
                level[:, bit] = _level(zeros, ones)
    return Prepared(out.reshape(len(ORDERS), -1), level.ravel())


def learn_weights(words: list[bytes], table: np.ndarray | Prepared, weights: np.ndarray) -> np.ndarray:
    """One online pass over words that occur once: each is predicted from the others, as a new one would be, and the
    weights follow its error."""
    for start in range(0, len(words), MINIBATCH):
        bits, *_ = bits_of(words[start : start + MINIBATCH])
        for part in bits:
            stretched, gate = _predicted(table, part, 1)
            mixed = 1 / (1 + np.exp(-_weighted(stretched, gate, weights)))
            level, pull = gate >> 3, part.times * (part.bit - mixed) * stretched
            passed = np.bincount(level, part.times, LEVELS)
            size = np.bincount(level, part.times * (stretched**2).mean(0), LEVELS)
            step = np.stack([np.bincount(level, row, LEVELS) for row in pull], 1) / (passed + size + 1e-9)[:, None]
            # A gate that few words pass moves little.
            own = slice(part.place, None, 8)
            weights[own] = np.clip(weights[own] + RATE * np.minimum(1, passed / 256)[:, None] * step, *WEIGHTS)
    return weights


def spelled(words: list[bytes], table: np.ndarray | Prepared, weights: np.ndarray) -> np.ndarray:
    """log10 of the probability of each word's bytes and its end."""
    out = np.zeros(len(words))
    for start in range(0, len(words), SPELLED):
        bits, owner, lengths = bits_of(words[start : start + SPELLED])
        total = np.zeros(len(lengths))
        for part in bits:
            stretched, gate = _predicted(table, part, 0)
            mixed = _weighted(stretched, gate, weights)
            byte = (byte if part.place else 0) - np.log(1 + np.exp(mixed * (1 - 2 * part.bit)))
            if part.place == 7:
                total[part.words] += byte[part.one]
        np.add.at(out[start : start + SPELLED], owner, total)
    return out / np.log(10)


class Totals(NamedTuple):
    """Of the training tokens: their number, how many are distinct, words that occur once, and texts."""

    tokens: int
    distinct: int
    once: int
    texts: int

    @property
    def frequency_share(self) -> float:
        """What words get by their frequency; the rest is spelled. Words seen once tell how likely a new one is."""
        words = self.tokens - self.texts
        return (words - self.once + 0.5) / (words + 1) if words else 0.0

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.distinct + 1))

    def new(self, count: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        """log10 of the probability of a word by its frequency, or else its spelling; ends keep their share."""
        share, words = self.frequency_share, max(1, self.tokens - self.texts)
        known = np.log10(np.maximum(share * count / words, 1e-300))
        return np.log10(1 - 10 ** self.end()) + np.where(count > 0, known, np.log10(1 - share) + spelling)

    def end(self) -> float:
        return float(np.log10((self.texts + 1) / (self.tokens + 2)))


def _first_flags(codes: np.ndarray) -> np.ndarray:
    """Which tokens are new; codes number the words of a text by first occurrence."""
    highest = np.maximum.accumulate(codes)
    return np.concatenate([[True], highest[1:] > highest[:-1]]) if len(codes) else np.empty(0, bool)


def repeat_cost(codes: np.ndarray) -> float:
    """log10 of the probability of the words that are not new, each by its frequency in the text so far."""
    if not len(codes):
        return 0.0
    # A word's tokens have 0, 1, 2 and so on of it before them: the product is a factorial.
    times = np.bincount(codes)
    factorials = np.concatenate([[0.0], np.cumsum(np.log10(np.arange(1, times.max())))])
    return float(factorials[times - 1].sum() - np.log10(np.flatnonzero(~_first_flags(codes))).sum())


def novelty_cost(flags: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each text's bits "is new", by predictors mixed and refined within the text.

    Contexts: the last three bits; how long the text is so far; how many of its tokens were new.
    """
    lengths = np.fromiter(map(len, flags), "int64", len(flags))
    out = np.zeros(len(flags))
    order = np.argsort(-lengths, kind="stable")
    for start in range(0, len(flags), ABREAST):
        chosen = order[start : start + ABREAST]
        _abreast([flags[k] for k in chosen], lengths[chosen], out, chosen)
    return out


def _abreast(flags: list[np.ndarray], lengths: np.ndarray, out: np.ndarray, places: np.ndarray) -> None:
    count = len(flags)
    # A predictor per context: of a text, of one of up to 20 states; with how often it was asked.
    chance, seen = np.full(3 * count * 20, 0.5), np.zeros(3 * count * 20)
    weights = np.full((2 * count, 3), 0.5)
    history, new = np.zeros(count, "int64"), np.zeros(count, "int64")
    total = np.zeros(count)
    flat = np.concatenate(flags) if count else np.empty(0, bool)
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if count else np.empty(0, "int64")
    # Where a text's predictors of each kind begin, and its weights.
    begin, own_weights = np.arange(3 * count).reshape(3, count) * 20, 2 * np.arange(count)
    context = np.empty((3, count), "int64")
    for t in range(int(lengths.max(initial=0))):
        n = int(np.searchsorted(-lengths, -t, "left"))
        bit = flat[at[:n] + t]
        asked = context[:, :n]
        asked[0] = history[:n] & 7
        asked[1] = min(19, t.bit_length())
        asked[2] = 8 * new[:n] // max(1, t)
        asked += begin[:, :n]
        p = chance.take(asked)
        stretched = np.log(p / (1 - p))
        gate = own_weights[:n] + (history[:n] & 1)
        own = weights.take(gate, axis=0)
        mixed = 1 / (1 + np.exp(-np.clip((own.T * stretched).sum(0), -12, 12)))
        total[:n] += np.log10(np.where(bit, mixed, 1 - mixed))
        weights[gate] = own + 0.02 * ((bit - mixed) * stretched).T
        times = np.minimum(seen.take(asked) + 1, 255)
        seen[asked] = times
        chance[asked] = np.minimum(np.maximum(p + (bit - p) / (times + 0.5), 1e-4), 1 - 1e-4)
        history[:n] = history[:n] << 1 | bit
        new[:n] += bit
    out[places] = total


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` and ``count``, over the texts with ``_train``; words of other texts alone count 0."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "_text", SLICE):
            words, sizes = split_words(batch.column("_text"))
            found = words.dictionary_encode()
            codes, every = found.indices.to_numpy(), len(found.dictionary)
            train = np.repeat(batch.column("_train").to_numpy(zero_copy_only=False).astype(bool), sizes)
            columns = [np.bincount(own, minlength=every) for own in (codes.compress(train), codes)]
            yield pa.RecordBatch.from_arrays([found.dictionary, *map(pa.array, columns)], ["word", "count", "every"])

    parts = texts.select("_train", "_text").mapInArrow(counted, "word binary, count long, every long")
    summed = parts.groupBy("word").agg(F.sum("count").alias("count"), F.sum("every").alias("every"))
    return written(summed, "words")


def _columns(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray]:
    return batch.column("word").to_pylist(), batch.column("count").to_numpy()


def by_significance(counts: np.ndarray) -> bytes:
    """Lowest bytes first, then the next ones: the higher ones, nearly all of them zero, are compressed away. The codec
    shortens frequent bytes, too, which that of a shuffle does not."""
    plain = np.ascontiguousarray(counts.view("uint8").reshape(-1, 4).T)
    return len(counts).to_bytes(4, "little") + pa.Codec("zstd", 1).compress(plain, asbytes=True)


def from_significance(found: bytes) -> np.ndarray:
    plain = pa.Codec("zstd").decompress(found[4:], 4 * int.from_bytes(found[:4], "little"))
    return np.ascontiguousarray(np.frombuffer(plain, "uint8").reshape(4, -1).T).view("int32").ravel()


def counts_of(parts: DataFrame, shape: tuple[int, int], add: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """A table of fixed size that ``add`` counts in, added up over all tasks."""
    blocks = shape[0] * shape[1] // BLOCK_SLOTS

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(shape, "int32")
        for batch in batches:
            add(batch, table)
        parts = table.reshape(blocks, BLOCK_SLOTS)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype("int32")), pa.array([by_significance(parts[k]) for k in used], pa.binary())],
            ["block", "counts"],
        )

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(from_significance(x).astype("int64") for x in group["counts"])
        full = np.minimum(total, 2**31 - 1).astype("int32")
        return pd.DataFrame({"block": group["block"].iloc[:1], "counts": [by_significance(full)]})

    table = np.zeros((blocks, BLOCK_SLOTS), "int32")
    each = parts.mapInArrow(gathered, "block int, counts binary")
    found = each.groupBy("block").applyInPandas(added, "block int, counts binary").toArrow()
    for block, counts in zip(found["block"].to_pylist(), found["counts"].to_pylist(), strict=True):
        table[block] = from_significance(counts)
    return table.reshape(shape[0], -1, 2)


def bit_counts(words: DataFrame) -> np.ndarray:
    """Counts (order, slot, bit) over all training words."""
    return counts_of(
        words.where("count > 0").select("word", "count"),
        (len(ORDERS), 2 << SLOT_BITS),
        lambda batch, table: gather_bits(*_columns(batch), table),
    )


def in_mixed_order(words: list[bytes]) -> list[bytes]:
    """By hash, so that what an online pass sees last is like all the rest."""
    return sorted(words, key=lambda word: (xxhash.xxh64_intdigest(word), word))


def mixing_weights(words: DataFrame, once: int, table) -> np.ndarray:
    """The mean of what each shard of the words that occur once (there are ``once``) teaches the mixer online.

    Shards are dealt out and read by the words' hashes, and their weights are added up as whole numbers, so the
    result does not depend on partitions.
    """
    even = np.full((GATES, len(ORDERS)), 1 / len(ORDERS))

    def learned(group: pa.Table) -> pa.Table:
        own = in_mixed_order(group["word"].to_pylist())
        counts = prepared(table.value, 1) if len(own) > MINIBATCH else table.value
        steps = np.rint(learn_weights(own, counts, even.copy()).ravel() * STEPS).astype("int64")
        return pa.table({"place": np.arange(even.size, dtype="int32"), "amount": steps * len(own)})

    shard = F.pmod(F.xxhash64("word"), F.lit(1 + once // SHARD_WORDS))
    each = words.where("count = 1").select("word", shard.alias("shard")).groupBy("shard").applyInArrow(
        learned, "place int, amount long"
    )
    found = each.groupBy("place").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")).toArrow()
    if not found.num_rows:
        return even
    weights = even.ravel()
    weights[found["place"].to_numpy()] = [int(amount) / once / STEPS for amount in found["amount"].to_pylist()]
    return weights.reshape(even.shape)


def spell(words: DataFrame, table, weights: np.ndarray) -> DataFrame:
    """Add ``spelling``, the log10 probability by their bits."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = None
        for batch in batches:
            ready = ready or prepared(table.value, 0)
            found = spelled(batch.column("word").to_pylist(), ready, weights)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "spelling"])

    return words.mapInArrow(scored, "word binary, count long, every long, spelling double")


def spell_words(words: DataFrame, table, weights: np.ndarray) -> DataFrame:
    """Add ``spelling`` to the words that training texts lack."""
    known = words.where("count > 0").withColumn("spelling", F.lit(0.0))
    return written(known.unionByName(spell(words.where("count = 0"), table, weights)), "spelled")


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = (7, 2)
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``
    (log10 probabilities, by word frequencies alone and by the model) and ``bits_per_byte`` (of the text's UTF-8 bytes).

    Learns from the rows whose ``crc32(id as text) mod held_out[0]`` is not ``held_out[1]``. A NULL or empty text is
    its end alone. Rows with the same id are texts of their own; further columns are not read. Without training rows
    every word is spelled by bits of even chance.
    """
    texts = docs.select(
        F.col(id_col).alias("_id"),
        (id_remainder(F.col(id_col), held_out[0]) != held_out[1]).alias("_train"),
        utf8(F.col(text_col)).alias("_text"),
    )
    words = count_words(texts)
    trained = texts.where("_train").count()
    row = words.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
        F.count_if(F.col("count") > 0).alias("v"),
        F.count_if(F.col("count") == 1).alias("once"),
    ).first()
    totals = Totals(row.n + trained, row.v + (trained > 0), row.once, trained)
    context = docs.sparkSession.sparkContext
    table = context.broadcast(bit_counts(words))
    vocabulary = spell_words(words, table, mixing_weights(words, row.once or 0, table))
    known = context.broadcast(_frequent(vocabulary, totals))
    parts = written(_looked_up(texts, id_type(docs, id_col), known, totals), "texts")
    rare = parts.select("_row", F.explode("rare").alias("r")).select("_row", "r.*")
    base, new = column_base(totals), _column_new(totals)
    found = (
        rare.join(vocabulary, "word")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * base).alias("more_base"),
            F.sum(new).alias("more"),
            F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        )
    )
    none = F.lit(0)
    score = F.col("score") + F.coalesce("more", none)
    return parts.join(found, "_row", "left").select(
        F.col("_id").alias(id_col),
        (~F.col("_train")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", none)).alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", none)).alias("base_score"),
        score.alias("score"),
        F.when(F.col("n_bytes") > 0, -score * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _frequent(vocabulary: DataFrame, totals: Totals) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Frequent words with their counts, costs, and the share that they leave to new words: those that spare a join,
    by their number in all texts, and those that leave a share, by their number in training texts."""
    short = vocabulary.where(F.length("word") <= KEY_BYTES)
    columns = ["word", "count", "spelling"]
    leaving = short.where("count > 0").orderBy(F.desc("count"), "word").limit(LEAVING).select(*columns).toArrow()
    looked = short.orderBy(F.desc("every"), "word").limit(TABLE_ENTRIES).select(*columns).toArrow()
    leave = set(leaving["word"].to_pylist())
    apart = pa.array([word not in leave for word in looked["word"].to_pylist()], pa.bool_())
    entries = pa.concat_tables([leaving, looked.filter(apart)])
    count = entries["count"].to_numpy()
    new = totals.new(count, entries["spelling"].to_numpy())
    share = np.where(np.arange(len(count)) < len(leave), 10.0**new, 0.0)
    return entries["word"].to_pylist(), count, totals.base(count), new, share


def column_base(totals: Totals) -> Column:
    return F.log10((F.col("count") + 1) / F.lit(float(totals.tokens + totals.distinct + 1)))


def _column_new(totals: Totals) -> Column:
    """As ``Totals.new``."""
    share, words = totals.frequency_share, max(1, totals.tokens - totals.texts)
    known = F.log10(F.lit(share / words) * F.col("count")) if share else F.lit(0.0)
    spelled = F.lit(float(np.log10(1 - share))) + F.col("spelling")
    return F.lit(float(np.log10(1 - 10 ** totals.end()))) + F.when(F.col("count") > 0, known).otherwise(spelled)


def _looked_up(texts: DataFrame, kind: str, known, totals: Totals) -> DataFrame:
    """Per text: what the broadcast table and the text itself say, and the words that the table lacks."""

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, count, base, new, leaves = known.value
        number = dict(zip(entries, range(len(entries)), strict=True))
        end_base, end = float(totals.base(np.array(totals.texts))), totals.end()
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            flags, rare, rare_times, ends = [], [], [], [0]
            for _, _, text in rows([batch]):
                words = words_of(text)
                order = dict.fromkeys(words)
                codes = np.fromiter(map(dict(zip(order, range(len(order)), strict=True)).__getitem__, words), "int64", len(words))
                place = np.fromiter(map(number.get, order, repeat(-1)), "int64", len(order))
                times, hit = np.bincount(codes, minlength=len(order)), place >= 0
                at, n = place[hit], times[hit]
                # A new word is none of those before it: what they would get is shared by the others.
                before = np.zeros(len(order) + 1)
                before[1:][hit] = leaves[at]
                spared = float(np.log10(np.maximum(1 - np.cumsum(before), 1e-9)).sum())
                flags.append(np.append(_first_flags(codes), True))
                values = (
                    len(words) + 1,
                    int(n[count[at] > 0].sum()) + (totals.texts > 0),
                    float(n @ base[at]) + end_base,
                    float(new[at].sum()) + end - spared + repeat_cost(codes),
                    len(text),
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                rare += compress(order, ~hit)
                rare_times.append(times[~hit])
                ends.append(len(rare))
            score = np.array(columns[3]) + novelty_cost(flags)
            listed = pa.StructArray.from_arrays(
                [pa.array(rare, pa.binary()), pa.array(np.concatenate([np.empty(0, "int64"), *rare_times]))],
                ["word", "times"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(score, pa.float64()),
                    pa.array(columns[4], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed),
                ],
                ["_id", "_train", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare"],
            )

    return texts.mapInArrow(
        looked_up,
        f"_id {kind}, _train boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, "
        "rare array<struct<word:binary,times:long>>",
    ).withColumn("_row", F.monotonically_increasing_id())
