"""Token counts by a two-tier lookup on the map side.

The first tier is a compact table of the lengths of frequent pre-tokens (runs without ASCII white space), which
every task gets by broadcast; the second a cache that a Python worker keeps for what the table lacks. Documents
are counted where they are read: no pre-token is shuffled. Which pre-tokens the table holds is found on a bounded
sample and affects speed alone, as a miss is encoded by the same tokenizer.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_type, rows, utf8
from tablewright.llm.vocabularies import json_tokenizer, vocabulary_path

TOKENIZER = "word_bpe_49k.json"
#: Entries of the broadcast table; longer pre-tokens than KEY_BYTES are left out, so it is 5 MB at most.
TABLE_ENTRIES = 65_536
KEY_BYTES = 64
#: Documents, on average, from which the table's entries are chosen.
SAMPLE_ROWS = 20_000
#: Entries that a worker's cache holds before it starts afresh.
CACHE_ENTRIES = 600_000


class LengthTable(NamedTuple):
    """Keys one after the other, where they end, and their numbers of tokens."""

    keys: bytes
    ends: np.ndarray
    lengths: np.ndarray

    def unpacked(self) -> dict[bytes, int]:
        starts = [0, *self.ends[:-1].tolist()]
        pairs = zip(starts, self.ends.tolist(), strict=True) if len(self.ends) else ()
        return dict(zip((self.keys[a:b] for a, b in pairs), self.lengths.tolist(), strict=True))


class PreTokenLengths(dict):
    """Numbers of tokens of pre-tokens: first the broadcast table, then what the worker encoded itself."""

    def __init__(self, tokenizer: str, table: dict[bytes, int]) -> None:
        super().__init__(table)
        self.table = table
        self.tokenizer = tokenizer

    def __missing__(self, pre_token: bytes) -> int:
        length = encoded_length(self.tokenizer, pre_token)
        if len(pre_token) <= KEY_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.table)
            self[pre_token] = length
        return length


_LENGTHS: dict[str, PreTokenLengths] = {}


def encoded_length(tokenizer: str, pre_token: bytes) -> int:
    text = pre_token.decode("utf-8", "replace")
    if tokenizer.endswith(".model"):
        return len(_pieces(tokenizer).encode(text, num_threads=1))
    return len(json_tokenizer(tokenizer).encode(text, add_special_tokens=False))


@functools.cache
def _pieces(name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))


def frequent_lengths(docs: DataFrame, text_col: str, tokenizer: str) -> LengthTable:
    """The lengths of the most frequent pre-tokens of a sample of ``docs``."""
    fraction = min(1.0, SAMPLE_ROWS / max(1, docs.count()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for (text,) in rows(batches):
            counts.update(text.split())
        top = [(key, n) for key, n in counts.most_common(TABLE_ENTRIES) if len(key) <= KEY_BYTES]
        keys, numbers = zip(*top, strict=True) if top else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(numbers, pa.int64())], ["key", "n"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            lengths = [encoded_length(tokenizer, key) for key in keys.to_pylist()]
            yield pa.RecordBatch.from_arrays([keys, pa.array(lengths, pa.int32())], ["key", "length"])

    sample = docs.select(utf8(F.col(text_col)).alias("_text")).sample(fraction, seed=7)
    top = (
        sample.mapInArrow(counted, "key binary, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "key")
        .limit(TABLE_ENTRIES)
        .select("key")
    )
    found = top.mapInArrow(encoded, "key binary, length int").collect()
    keys = [bytes(row.key) for row in found]
    return LengthTable(
        b"".join(keys), np.cumsum([len(key) for key in keys], dtype="uint32"), np.array([r.length for r in found], "uint16")
    )


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8) and ``n_tokens``, without added special tokens.

    For tokenizers that drop white space, so that pre-tokens can be counted each by itself. A NULL or empty text
    has no bytes and no tokens. Repeated rows are counted each; further columns are not read.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text_col, tokenizer))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = worker_lengths(tokenizer, table)
        for batch in batches:
            sizes, totals = [], []
            for _, text in rows([batch]):
                sizes.append(len(text))
                totals.append(sum(map(lengths.__getitem__, text.split())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())],
                ["_id", "n_bytes", "n_tokens"],
            )

    return (
        docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("_text"))
        .mapInArrow(counted, f"_id {id_type(docs, id_col)}, n_bytes long, n_tokens long")
        .withColumnRenamed("_id", id_col)
    )


def worker_lengths(tokenizer: str, table: Broadcast) -> PreTokenLengths:
    """The worker's lookup, kept between tasks; a new table does not make what was encoded wrong."""
    if tokenizer not in _LENGTHS:
        _LENGTHS[tokenizer] = PreTokenLengths(tokenizer, table.value.unpacked())
    return _LENGTHS[tokenizer]
