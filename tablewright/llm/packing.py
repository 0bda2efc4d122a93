"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Documents of the same length are interchangeable, so best-fit decreasing over all documents is decided by the
histogram of piece lengths alone: at most ``capacity`` counters, whatever the number of documents. The plan made
from it says, for a range of ranks within a length, which run of sequences they fill and at which offset. Spark
makes the pieces, their histogram and their ranks, and looks each piece up in the plan.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import id_type, rows, utf8, written
from tablewright.llm.vocabularies import json_tokenizer

TOKENIZER = "byte_bpe_50k.json"
#: Entries that a worker's cache of encoded words holds before it starts afresh.
CACHE_ENTRIES = 600_000
#: Longer words are encoded without being kept.
CACHED_CHARACTERS = 64
#: Mean number of pieces that one task numbers for a length and salt.
RANK_ROWS = 5_000


class CapacityTree:
    """A segment tree over remaining capacities: which of them have an open sequence."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.marked = bytearray(2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        node = self.leaves + capacity
        self.marked[node] = is_open
        while node > 1:
            node //= 2
            self.marked[node] = self.marked[2 * node] or self.marked[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest open capacity of at least ``need``."""
        node = self.leaves + need
        if self.marked[node]:
            return need
        while node > 1 and (node % 2 or not self.marked[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.marked[2 * node] else 2 * node + 1
        return node - self.leaves


class Run(NamedTuple):
    """Pieces of one length with ranks from ``low`` on: ``each`` of them go to one sequence, from ``first`` on."""

    length: int
    low: int
    first: int
    each: int
    offset: int


def best_fit_plan(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Best-fit decreasing for ``histogram`` (length to count): its runs, and the number of sequences.

    A sequence just filled is the tightest open one while it has room, so it takes as many pieces of a length as
    fit; equal sequences are handled together. A length adds at most three groups of equal sequences, so there are
    at most ``3 * capacity`` groups and ``3 * capacity ** 2 / 2`` runs; natural corpora need a few thousand.
    """
    tree, groups = CapacityTree(capacity), [deque() for _ in range(capacity + 1)]
    runs: list[Run] = []
    sequences = 0

    def keep(room: int, first: int, count: int) -> None:
        if room and count:
            groups[room].appendleft((first, count))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        low, count = 0, histogram[length]
        while low < count:
            room = tree.tightest(length)
            if room is None:
                opened = -(-(count - low) // (capacity // length))
                keep(capacity, sequences, opened)
                sequences += opened
                room = capacity
            first, available = groups[room].popleft()
            tree.set(room, bool(groups[room]))
            each = room // length
            full = min(available, (count - low) // each)
            if full:
                runs.append(Run(length, low, first, each, capacity - room))
                low += full * each
                keep(room - each * length, first, full)
            rest = count - low
            if full < available and rest:
                runs.append(Run(length, low, first + full, rest, capacity - room))
                low = count
                keep(room - rest * length, first + full, 1)
                full += 1
            keep(room, first + full, available - full)
    return runs, sequences


#: The bytes that byte-level vocabularies write as themselves; the others follow from U+0100 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {chr(b): chr(b) for b in PRINTABLE} | {
    chr(b): chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(PRINTABLE))
}
BYTE_LEVEL = str.maketrans(BYTE_CHARACTERS)
#: A space beside other white space; elsewhere a text can be cut before a space, as no token spans it.
ADJACENT_SPACES = re.compile(r" \s|\s ")
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Words that the pre-tokenizer leaves whole, and the marks around them that it splits off whole.
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
MARKS = frozenset(string.punctuation) - {"'"}


def _simple(word: str) -> bool:
    """Whether a word is ASCII letters, or these and one mark: what can be told without a pattern."""
    return word.isascii() and (word.isalpha() or (word[-1:] in MARKS and word[:-1].isalpha()))


class WordIds(dict):
    """Little-endian ids of a word with a space before it, encoded when first asked for."""

    def __init__(self, tokenizer: str) -> None:
        super().__init__()
        self.tokenizer = json_tokenizer(tokenizer)
        self.tokenize = self.tokenizer.model.tokenize
        self.parts: dict[str, bytes] = {}
        self.written = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]

    def __missing__(self, word: str) -> bytes:
        head, line_break, rest = word.partition("\n")
        if _simple(head) and not line_break:
            ids = self.letters("Ġ" + word) if word.isalpha() else self[word[:-1]] + self.part(word[-1])
        elif _simple(head) and _simple(rest):
            # The pre-tokenizer splits off a single line break between two words.
            ids = self[head] + self.part(line_break) + self.encode(rest)
        else:
            ids = self.encode(" " + word)
        if len(word) <= CACHED_CHARACTERS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        plain = PLAIN.fullmatch(text)
        if plain is None or len(text) > CACHED_CHARACTERS:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.part, plain.groups()))

    def letters(self, piece: str) -> bytes:
        """Ids of a pre-token, written as the vocabulary writes it."""
        return b"".join([self.written[token.id] for token in self.tokenize(piece)])

    def part(self, piece: str) -> bytes:
        ids = self.parts.get(piece)
        if ids is None:
            ids = self.letters(piece.encode().decode("latin-1").translate(BYTE_LEVEL)) if piece else b""
            if len(self.parts) >= CACHE_ENTRIES:
                self.parts.clear()
            self.parts[piece] = ids
        return ids

    def of_text(self, text: str) -> bytes:
        if not text:
            return b""
        first, *words = CUT.split(text) if ADJACENT_SPACES.search(text) else text.split(" ")
        return self.encode(first) + b"".join(map(self.__getitem__, words))


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(tokenizer: str) -> WordIds:
    """The worker's own encoder, kept between tasks."""
    if tokenizer not in _WORD_IDS:
        _WORD_IDS[tokenizer] = WordIds(tokenizer)
    return _WORD_IDS[tokenizer]


def token_pieces(
    docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, tokenizer: str, keep_ids: bool
) -> DataFrame:
    """Cut each document's ids, the end id included, into pieces of at most ``capacity``; only the first is shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            found: list[tuple] = []
            for key, text in rows([batch]):
                ids = encoder.of_text(text.decode("utf-8", "replace")) + end
                ends = range(len(ids) % step or step, len(ids) + 1, step)
                for piece, stop in enumerate(ends):
                    start = max(0, stop - step)
                    part = ids[start:stop]
                    found.append((key, piece, start // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<u4")))
            columns = list(zip(*found, strict=True)) or [()] * 6
            arrays = [
                pa.array(columns[0], batch.schema.field(0).type),
                pa.array(columns[1], pa.int32()),
                *(pa.array(column, pa.int64()) for column in columns[2:5]),
            ]
            names = ["_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                arrays.append(pa.array([x.astype("<i4") for x in columns[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"_id {id_type(docs, id_col)}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("_text")).mapInArrow(
        cut, schema + ", ids array<int>" * keep_ids
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    tokenizer: str = TOKENIZER,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``keep_ids`` adds the token ids. A NULL or empty text is one piece of the end id alone. Rows with the same id
    are documents of their own, with the same piece numbers. Further columns of ``docs`` are not read. No rows
    give no rows.
    """
    pieces = written(token_pieces(docs, id_col, text_col, capacity, end_id, tokenizer, keep_ids), "pieces")
    partial = pieces.where(F.col("length") < capacity)
    full = pieces.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    histogram = {r.length: r.n for r in partial.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs, _ = best_fit_plan(histogram, capacity)
    placed = _placed(_ranked(partial, sum(histogram.values())), runs)
    out = placed.unionByName(full)
    return out.withColumnRenamed("_id", id_col)


def _ranked(pieces: DataFrame, count: int) -> DataFrame:
    """Number the pieces of each length from 0: within a length and salt, after the counts of lower salts."""
    salts = 1 + count // RANK_ROWS
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy("length", "_salt")
        .agg(F.count("*").alias("_n"))
        .select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    order = Window.partitionBy("length", "_salt").orderBy("_id", "piece", "ids_crc32")
    numbered = salted.withColumn("_within", F.row_number().over(order) - 1)
    return (
        numbered.join(offsets, ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_within"))
        .drop("_salt", "_before", "_within")
    )


def _placed(ranked: DataFrame, runs: list[Run]) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; the plan is bounded by the capacity and travels with the task."""
    table = np.array(runs, "int64").reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    columns = [name for name in ranked.columns if name != "_rank"]
    scale = int(table[:, 1].max(initial=0)) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A run is found by its length and lowest rank, joined into one sorted number.
        starts = table[:, 0] * scale + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            run = table[np.searchsorted(starts, length * scale + np.minimum(rank, scale - 1), "right") - 1]
            nth, within = np.divmod(rank - run[:, 1], run[:, 3])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in columns),
                    pa.array(run[:, 2] + nth),
                    pa.array(run[:, 4] + within * length),
                ],
                [*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{name}` {ranked.schema[name].dataType.simpleString()}" for name in columns)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
