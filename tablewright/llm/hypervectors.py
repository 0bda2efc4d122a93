"""Languages of texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds those of its
letters, each rotated by its place from the end, by multiplying them. A text's profile bundles (adds) the vectors of
its n-grams, a language's profile those of all its training texts, and a text gets the language with the largest
cosine. Profiles are sums, so training adds up per task and language, whatever the sizes of languages and texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_remainder, id_type, written

UNKNOWN = "und"
DIMENSIONS = 2048
#: Letters in an n-gram; three code points of 21 bits fit a long.
LETTERS = 3
SEED = 20_240_613
#: n-grams whose vectors a worker keeps, and that are bundled at once.
KEPT_GRAMS = 16_384
#: Languages that the profiles sent to the workers may have (16 KiB each); more are an error.
MAX_LANGUAGES = 4096


@functools.cache
def _is_letter(code_point: int) -> bool:
    return chr(code_point).isalpha()


def letter_grams(text: str) -> np.ndarray:
    """The text's n-grams as longs, repeats included; empty if it has no letter.

    Letters are lower-cased; anything between two words, and before and after the text, is one gap, written as 0.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    found, place = np.unique(points, return_inverse=True)
    letters = np.where(np.array([_is_letter(p) for p in found.tolist()], bool)[place], points, 0) if len(points) else points
    padded = np.concatenate([[0], letters, [0]]).astype("int64")
    kept = np.concatenate([[True], (padded[1:] != 0) | (padded[:-1] != 0)])
    padded = padded[kept]
    if len(padded) < LETTERS:
        return np.zeros(0, "int64")
    return padded[:-2] << 42 | padded[1:-1] << 21 | padded[2:]


@functools.lru_cache(4096)
def _letter_vector(code_point: int) -> np.ndarray:
    return np.random.default_rng([SEED, code_point]).integers(0, 2, DIMENSIONS, dtype="int8") * 2 - 1


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """A row per n-gram: its letters' vectors, rotated by their distance from its end, multiplied."""
    out = np.ones((len(grams), DIMENSIONS), "int8")
    for place in range(LETTERS):
        points, row = np.unique(grams >> (21 * place) & 0x1FFFFF, return_inverse=True)
        if len(points):
            out *= np.array([np.roll(_letter_vector(p), place) for p in points.tolist()])[row]
    return out


class GramCache:
    """Vectors of n-grams met so far, at most ``KEPT_GRAMS`` of them; beyond, a worker starts anew."""

    def __init__(self) -> None:
        self.known, self.vectors = np.zeros(0, "int64"), np.zeros((0, DIMENSIONS), "int8")

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of sorted, distinct n-grams, at most ``KEPT_GRAMS`` at once."""
        new = np.setdiff1d(grams, self.known, assume_unique=True)
        if len(new):
            if len(new) + len(self.known) > KEPT_GRAMS:
                self.known, self.vectors, new = self.known[:0], self.vectors[:0], grams
            known = np.concatenate([self.known, new])
            order = np.argsort(known)
            self.known, self.vectors = known[order], np.concatenate([self.vectors, gram_vectors(new)])[order]
        return self.vectors[np.searchsorted(self.known, grams)]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the vectors of distinct n-grams, each as often as it occurs."""
        total = np.zeros(DIMENSIONS)
        for start in range(0, len(grams), KEPT_GRAMS):
            part = slice(start, start + KEPT_GRAMS)
            total += counts[part].astype("float32") @ self.rows(grams[part]).astype("float32")
        return total


@functools.cache
def _cache() -> GramCache:
    """One cache per worker process, also across its tasks."""
    return GramCache()


def language_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages, in order, and a unit profile for each, bundled from every row of ``labelled``.

    Tasks add up one vector per language, so what is shuffled does not depend on the number of texts. Rows without
    text, letter or language add nothing. Languages are compared as text.
    """

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, totals = _cache(), {}
        for batch in batches:
            langs, texts = batch.columns
            grams: dict[str, list] = {}
            size = 0

            def add() -> None:
                for lang, found in grams.items():
                    totals[lang] = totals.get(lang, 0) + cache.bundle(*np.unique(np.concatenate(found), return_counts=True))
                grams.clear()

            for lang, text in zip(langs, texts, strict=True):
                found = letter_grams(text.as_py())
                if len(found):
                    grams.setdefault(lang.as_py(), []).append(found)
                    size += len(found)
                if size > 1 << 21:
                    add()
                    size = 0
            add()
            if len(totals) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for lang, total in totals.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * DIMENSIONS, "place": np.arange(DIMENSIONS, dtype="int32"), "total": total}
            )

    texts = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = texts.dropna().mapInArrow(bundled, "lang string, place int, total double")
    # Written, as they are read twice: first the languages, then their profiles.
    sums = written(parts.groupBy("lang", "place").agg(F.sum("total").alias("total")), "profiles")
    langs = [r.lang for r in sums.where("place = 0").select("lang").orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    profiles, at = np.zeros((len(langs), DIMENSIONS)), {lang: k for k, lang in enumerate(langs)}
    for r in sums.collect():
        profiles[at[r.lang], r.place] = r.total
    return langs, _unit(profiles)


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=-1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def predict_languages(
    table: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang_pred`` and ``score`` (the cosine with that language's profile, at least 0) for every row of ``table``.

    Learns from the texts and languages of ``labelled``; of a row of ``table`` the text alone is looked at. A text
    that is NULL or has no letter is ``und`` with score 0, and so is every text if there is nothing to learn from.
    Equal cosines go to the language that is first as text. Repeated rows and ids are kept, and other columns do not
    matter, whatever their names. A text of any length costs memory for itself and its distinct n-grams.
    """
    langs, profiles = language_profiles(labelled, text_col, lang_col)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache()
        for batch in batches:
            names, scores = [], []
            for text in batch.column(1):
                text = text.as_py()
                grams = letter_grams(text) if text and langs else ()
                if len(grams):
                    cosines = profiles @ _unit(cache.bundle(*np.unique(grams, return_counts=True)))
                    best = int(cosines.argmax())
                    names.append(langs[best])
                    scores.append(min(1.0, max(0.0, float(cosines[best]))))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [id_col, "lang_pred", "score"],
            )

    texts = table.select(id_col, F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(predicted, f"`{id_col}` {id_type(table, id_col)}, lang_pred string, score double")


def held_out_languages(table: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Languages of all rows, learned from those whose ``crc32(id) mod 4`` is not 2; ``held_out`` tells the others."""
    held_out = id_remainder(F.col(id_col), 4) == 2
    found = predict_languages(table, table.where(~held_out), id_col, text_col, lang_col)
    return found.select(id_col, held_out.alias("held_out"), "lang_pred", "score")
