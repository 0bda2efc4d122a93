"""Byte-level BPE encoding with tiktoken, and decoding back to the raw bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_type, rows, utf8
from tablewright.llm.vocabularies import rank_tokenizer

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a text that are encoded at once.
PART_CHARACTERS = 65_536
#: White space as the pattern's ``\s`` has it.
SPACE = r"[\t-\r \x85\xa0  -     　]"
#: No match of the pattern spans a single space between other characters.
CUT = regex.compile(rf"(?<!{SPACE}) (?!{SPACE}|$)")
#: Longer runs of white space overflow the pattern's backtracking; the match is all of it but what belongs to the next.
LONG_RUN = 10_000
LONG_SPACES = regex.compile(rf"{SPACE}{{{LONG_RUN},}}+")


def parts(text: str) -> Iterator[str]:
    """Cut a long text where no match of the pattern is cut; a part is larger only where there is no such place."""
    start = 0
    while len(text) - start > PART_CHARACTERS:
        found = CUT.search(text, start + PART_CHARACTERS)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode(encoding, text: str) -> list[int]:
    """Token ids as the library gives them for the whole text, for texts of any length."""
    ids: list[int] = []
    for part in parts(text):
        start = 0
        for run in LONG_SPACES.finditer(part) if len(part) >= LONG_RUN else ():
            # The pattern leaves the last space of a run to what follows, if anything follows.
            stop = run.end() - (run.end() < len(part))
            ids += encoding.encode_ordinary(part[start : run.start()])
            ids += encoding._encode_single_piece(part[run.start() : stop])
            start = stop
        ids += encoding.encode_ordinary(part[start:])
    return ids


def encode_decode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, pattern: str = PATTERN
) -> DataFrame:
    """One row per document: id, ``ids`` (array of int) and ``decoded`` (the bytes the ids stand for).

    A NULL or empty text has no ids. Repeated rows are encoded each; further columns are not read.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_tokenizer(ranks, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [encode(encoding, text.decode("utf-8", "replace")) for _, text in rows([part])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([encoding.decode_bytes(x) for x in ids], pa.binary()),
                    ],
                    ["_id", "ids", "decoded"],
                )

    return (
        docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("_text"))
        .mapInArrow(encoded, f"_id {id_type(docs, id_col)}, ids array<int>, decoded binary")
        .withColumnRenamed("_id", id_col)
    )
