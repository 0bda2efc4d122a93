"""Toxicity from two class-conditional Kneser-Ney models.

Either class has an interpolated Kneser-Ney model of words: words back off to their first bytes, and these to shared
continuation counts: in how many words of either class they occur. A rare word therefore differs between the
classes by what its beginning tells, and one never seen by almost nothing. With ``bigrams`` either class also has a
bigram model, which backs off to how many words a word follows. A text is judged by the difference of the two
log-likelihoods per word, over the whole text and over its worst windows, so that a few expressions are not diluted by
length, for each order; a logistic curve, fitted on rows that the counts have not seen, turns these into a
probability, so that labels that hang on single expressions lose nothing to the bigrams.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import id_remainder, rows, utf8, written

#: Labelled rows, on average, from which a model is fitted; a quarter of them fits the curve.
SAMPLE_ROWS = 40_000
CURVE_SHARE = 4
#: Entries of each table that goes to the tasks (log ratios of words, beginnings, bigrams and their parts): 30 MB in all
#: at most.
TABLE_ENTRIES = 131_072
#: Longer expressions are left to their beginnings.
KEY_BYTES = 48
DISCOUNT = 0.75
BEGINNINGS = (7,)
WINDOWS = (1, 3, 6, 12, 25)
THRESHOLD = 0.3
#: Entries of a task's counter before its counts go on.
COUNTER_ENTRIES = 500_000

#: ASCII letters are lower-cased, digits and bytes of other characters stay, the rest parts words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass
class Ratios:
    """Log ratios toxic : ordinary of what a text is made of, and the curve over a text's features."""

    words: dict[bytes, float] = field(default_factory=dict)
    backoffs: dict[bytes, float] = field(default_factory=dict)
    bigrams: dict[bytes, float] = field(default_factory=dict)
    continued: dict[bytes, float] = field(default_factory=dict)
    beginnings: list[dict[bytes, float]] = field(default_factory=lambda: [{} for _ in BEGINNINGS])
    unseen: float = 0.0
    curve: np.ndarray | None = None
    constant: float = 0.0

    def word(self, word: bytes) -> float:
        found = self.words.get(word)
        if found is None:
            for length, table in zip(BEGINNINGS, self.beginnings, strict=True):
                found = table.get(word[:length])
                if found is not None:
                    return found
            return self.unseen
        return found

    @property
    def n_features(self) -> int:
        return (len(WINDOWS) + 1) * (2 if self.bigrams else 1) + 1

    def features(self, words: list[bytes]) -> list[float]:
        """Mean ratio per word and the largest means of windows, by words and by bigrams; the logarithm of the length."""
        if not words:
            return [0.0] * self.n_features
        known = _Known(self)
        ratio = np.fromiter(map(known.__getitem__, words), "float64", len(words))
        ratios = [ratio]
        if self.bigrams:
            pairs = list(map(self.bigrams.get, map(b" ".join, zip(words, words[1:], strict=False))))
            after = np.fromiter(map(self.backoffs.get, words[:-1], repeat(0.0)), "float64", len(pairs))
            follow = np.fromiter(map(self.continued.get, words[1:], ratio[1:].tolist()), "float64", len(pairs))
            ratios.append(np.concatenate([ratio[:1], after + follow]))
            for at in [k for k, pair in enumerate(pairs) if pair is not None]:
                ratios[1][at + 1] = pairs[at]
        out = []
        for own in ratios:
            sums = np.concatenate([[0.0], np.cumsum(own)])
            wide = [min(window, len(words)) for window in WINDOWS]
            out += [float(own.mean()), *(float((sums[k:] - sums[:-k]).max()) / k for k in wide)]
        return [*out, math.log1p(len(words))]

    def probability(self, features: np.ndarray) -> np.ndarray:
        """Of a batch of rows of features."""
        if self.curve is None:
            return np.full(len(features), self.constant)
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[:-1] + self.curve[-1], -35, 35)))


class _Known(dict):
    """Ratios of the words of one text."""

    def __init__(self, ratios: Ratios) -> None:
        super().__init__()
        self.ratio = ratios.word

    def __missing__(self, word: bytes) -> float:
        found = self[word] = self.ratio(word)
        return found


def _counted(batches: Iterator[pa.RecordBatch], bigrams: bool) -> Iterator[pa.RecordBatch]:
    """Occurrences in either class, by order: 0 bigrams, if asked for, 1 words, then beginnings."""
    counts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        entries = list(counts.items())
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([order for (_, order, _), _ in entries], pa.int32()),
                pa.array([key for (_, _, key), _ in entries], pa.binary()),
                pa.array([n * (1 - toxic) for (toxic, _, _), n in entries], pa.int64()),
                pa.array([n * toxic for (toxic, _, _), n in entries], pa.int64()),
            ],
            ["n", "key", "ordinary", "toxic"],
        )

    for toxic, text in rows(batches):
        words = words_of(text)
        if bigrams:
            counts.update((toxic, 0, pair) for pair in map(b" ".join, zip(words, words[1:], strict=False)))
        counts.update((toxic, 1, word) for word in words)
        for order, length in enumerate(BEGINNINGS, 2):
            counts.update((toxic, order, word[:length]) for word in words)
        if len(counts) > COUNTER_ENTRIES:
            yield flushed()
    yield flushed()


def _kept_mass(total: Column) -> Column:
    return F.when(total > 0, total).otherwise(1)


def fit_ratios(labelled: DataFrame, bigrams: bool = False) -> Ratios:
    """Fit on rows ``_toxic`` (0 or 1), ``_text`` (binary) and ``_curve`` (whether the row fits the curve)."""
    counts = written(
        labelled.where(~F.col("_curve"))
        .select("_toxic", "_text")
        .mapInArrow(lambda batches: _counted(batches, bigrams), "n int, key binary, ordinary long, toxic long")
        .where(F.length("key") <= KEY_BYTES)
        .groupBy("n", "key")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")),
        "class-counts",
    )
    totals = {
        row.n: row
        for row in counts.groupBy("n")
        .agg(
            F.sum("ordinary").alias("ordinary"),
            F.sum("toxic").alias("toxic"),
            F.count_if(F.col("ordinary") > 0).alias("ordinary_types"),
            F.count_if(F.col("toxic") > 0).alias("toxic_types"),
            F.count("*").alias("types"),
        )
        .collect()
    }
    ratios = Ratios()
    shares = {row._toxic: row.n for row in labelled.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    if 1 not in totals or not (totals[1].ordinary and totals[1].toxic):
        ratios.constant = shares.get(1, 0) / max(1, sum(shares.values()))
        return ratios

    classes = ("ordinary", "toxic")
    mass = {(n, c): DISCOUNT * totals[n][f"{c}_types"] / totals[n][c] for n in totals if n for c in classes}

    def discounted(n: int, c: str) -> Column:
        return F.greatest(F.col(c) - DISCOUNT, F.lit(0)) / totals[n][c]

    def ratio(scale: tuple[float, float] = (1.0, 1.0)) -> Column:
        return F.log(F.col("p_toxic") * scale[1] / (F.col("p_ordinary") * scale[0]))

    # From the shortest beginnings up: what a level adds to the one below, spread over the types seen under it.
    words = counts.where("n = 1")
    last = len(BEGINNINGS) + 1
    shared = words.groupBy(F.substring("key", 1, BEGINNINGS[-1]).alias("key")).agg(F.count("*").alias("under"))
    level = counts.where(F.col("n") == last).join(shared, "key")
    level = level.select(
        "key",
        (F.col("ordinary") + F.col("toxic")).alias("seen"),
        *(
            (discounted(last, c) + mass[last, c] * F.col("under") / (totals[1]["types"] + 1)).alias(f"p_{c}")
            for c in classes
        ),
    )
    # What a word without an entry of its own has lost on the way down: the discounts of the levels above.
    lost = tuple(mass[1, c] for c in classes)
    lost_below = [lost]
    for n in range(2, last + 1):
        lost = tuple(x * mass[n, c] for x, c in zip(lost, classes, strict=True))
        lost_below.append(lost)
    ratios.unseen = math.log(lost_below[-1][1] / lost_below[-1][0])

    def interpolated(own: DataFrame, lower: DataFrame, length: int, total, *kept: str) -> DataFrame:
        """Discounted counts of ``own``, and what they lose spread over the types that share a beginning."""
        own = own.withColumn("below", F.substring("key", 1, length))
        spread = own.groupBy("below").agg(F.count("*").alias("under"))
        below = lower.select(F.col("key").alias("below"), *(F.col(f"p_{c}").alias(f"b_{c}") for c in classes))

        def interpolation(c: str) -> Column:
            lost = DISCOUNT * total[f"{c}_types"] / total[c]
            return F.greatest(F.col(c) - DISCOUNT, F.lit(0)) / total[c] + lost * F.col(f"b_{c}") / (F.col("under") + 1)

        return (
            own.join(spread, "below")
            .join(below, "below")
            .select(
                "key",
                (F.col("ordinary") + F.col("toxic")).alias("seen"),
                *(interpolation(c).alias(f"p_{c}") for c in classes),
                *kept,
            )
        )

    tables = {last: level}
    for n in range(last - 1, 0, -1):
        level = interpolated(
            counts.where(F.col("n") == n), tables[n + 1], BEGINNINGS[n - 1], totals[n], *(classes if n == 1 else ())
        )
        tables[n] = level = written(level, "class-level")
    for place, n in enumerate(range(2, last + 1)):
        ratios.beginnings[place] = _top(tables[n], ratio(lost_below[place]))
    ratios.words = _top(tables[1].where("seen > 1"), ratio())
    if bigrams:
        pairs = counts.where("n = 0")
        follow = pairs.select(
            F.substring_index(F.col("key").cast("string"), " ", -1).cast("binary").alias("key"),
            *((F.col(c) > 0).cast("int").alias(c) for c in classes),
        )
        follow = follow.groupBy("key").agg(*(F.sum(c).alias(c) for c in classes))
        total = follow.agg(*(F.sum(c).alias(c) for c in classes), *(F.count_if(F.col(c) > 0).alias(f"{c}_types") for c in classes)).first()
        if total.ordinary and total.toxic:
            continued = written(interpolated(follow, tables[2], BEGINNINGS[0], total), "class-continued")
            ratios.continued = _top(continued, ratio())
            _add_bigrams(ratios, pairs.where("ordinary + toxic > 2"), tables[1], continued)
    _fit_curve(ratios, labelled.where("_curve"))
    return ratios


def _top(table: DataFrame, value: Column) -> dict[bytes, float]:
    """The most frequent entries, as many as a task's table may hold."""
    found = table.orderBy(F.desc("seen"), "key").limit(TABLE_ENTRIES).select("key", value.alias("value")).toArrow()
    return dict(zip(found["key"].to_pylist(), found["value"].to_pylist(), strict=True))


def _add_bigrams(ratios: Ratios, bigrams: DataFrame, words: DataFrame, continued: DataFrame) -> None:
    """Ratios of frequent bigrams, and for each first word what its other followers are left with; ``continued`` has
    the probabilities of words as followers of any word."""
    text = F.col("key").cast("string")
    parts = bigrams.select(
        F.substring_index(text, " ", 1).cast("binary").alias("first"),
        F.substring_index(text, " ", -1).cast("binary").alias("second"),
        "key",
        *(F.col(c).alias(f"n_{c}") for c in ("ordinary", "toxic")),
    )
    firsts = words.select(F.col("key").alias("first"), *(F.col(c).alias(f"f_{c}") for c in ("ordinary", "toxic")))
    seconds = continued.select(F.col("key").alias("second"), "p_ordinary", "p_toxic")

    def taken(c: str) -> Column:
        return F.coalesce(F.greatest(F.col(f"n_{c}") - DISCOUNT, F.lit(0)) / _kept_mass(F.col(f"f_{c}")), F.lit(0))

    joined = parts.join(firsts, "first")
    left = joined.groupBy("first").agg(
        F.sum(F.col("n_ordinary") + F.col("n_toxic")).alias("seen"),
        *((1 - F.sum(taken(c))).alias(f"l_{c}") for c in ("ordinary", "toxic")),
    )
    left = written(left, "class-backoffs")
    ratios.backoffs = _top(left.withColumnRenamed("first", "key"), F.log(F.col("l_toxic") / F.col("l_ordinary")))
    full = joined.join(left.drop("seen"), "first").join(seconds, "second")
    value = F.log(
        (taken("toxic") + F.col("l_toxic") * F.col("p_toxic")) / (taken("ordinary") + F.col("l_ordinary") * F.col("p_ordinary"))
    )
    ratios.bigrams = _top(full.withColumn("seen", F.col("n_ordinary") + F.col("n_toxic")), value)


def _fit_curve(ratios: Ratios, labelled: DataFrame) -> None:
    """Ridge-penalised logistic regression by Newton's method on standardised features."""
    found = _features(labelled.select("_toxic", "_text"), ratios, "_toxic int").toArrow()
    y = found["_toxic"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        ratios.constant = float(y.mean()) if len(y) else 0.0
        return
    x = np.array(found["features"].to_pylist())
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    penalty = np.array([1.0] * (x.shape[1] - 1) + [1e-6])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -35, 35)))
        gradient = x.T @ (p - y) + penalty * weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    plain = weights[:-1] / scale
    ratios.curve = np.append(plain, weights[-1] - plain @ mean)


def _features(texts: DataFrame, ratios: Ratios, kept: str) -> DataFrame:
    """The first column of ``texts`` and the features of the second; the ratios are broadcast."""
    shared = texts.sparkSession.sparkContext.broadcast(ratios)
    name = kept.split(" ", 1)[0]

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.features(words_of(text)) for _, text in rows([batch])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], [name, "features"]
            )

    return texts.mapInArrow(computed, f"{kept}, features array<double>")


def fit_on_labels(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out: tuple[int, int] = (4, 2),
    sample_rows: int = SAMPLE_ROWS,
    bigrams: bool = False,
) -> Ratios:
    """Fit on about ``sample_rows`` of the labelled documents that are not held out, as ``score_toxicity`` says."""
    known = (
        labels.select(F.col(id_col).alias("_key"), F.col(label_col).cast("int").alias("_toxic"))
        .where("_key is not null and _toxic in (0, 1)")
        .where(id_remainder(F.col("_key"), held_out[0]) != held_out[1])
        .groupBy("_key")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    million = 1_000_000
    share = math.ceil(million * min(1.0, sample_rows / max(1, known.count())))
    sampled = known.where(F.pmod(F.xxhash64(F.col("_key").cast("string")), F.lit(million)) < share)
    texts = docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("_text"))
    # The sample is bounded, so it can be sent to where the texts are read.
    labelled = written(
        texts.join(F.broadcast(sampled), F.col("_id") == F.col("_key")).select(
            "_toxic",
            "_text",
            (F.pmod(F.xxhash64(F.lit("curve"), F.col("_key").cast("string")), F.lit(CURVE_SHARE)) == 0).alias("_curve"),
        ),
        "labelled",
    )
    return fit_ratios(labelled, bigrams)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out: tuple[int, int] = (4, 2),
    sample_rows: int = SAMPLE_ROWS,
    bigrams: bool = False,
) -> DataFrame:
    """One row per document: id and ``score``, the probability of label 1.

    Labels are learned from ``labels`` (``id_col`` and ``label_col``; NULL labels say nothing, of several the
    largest counts) of documents whose ``crc32(id as text) mod held_out[0]`` is not ``held_out[1]``, about
    ``sample_rows`` of them. A NULL or empty text has the features of no words. Rows with the same id are scored
    each. Without labels of both classes all scores are the share of label 1 in the sample, or 0. Further columns
    are not read.
    """
    ratios = fit_on_labels(docs, labels, id_col, text_col, label_col, held_out, sample_rows, bigrams)
    probability = probability_column(docs.sparkSession, ratios)
    return docs.select(id_col, probability(F.col(text_col)).alias("score"))


def probability_column(spark: SparkSession, ratios: Ratios) -> Callable[[Column], Column]:
    """A function from a column of texts to the probability of label 1; the ratios are broadcast."""
    shared = spark.sparkContext.broadcast(ratios)

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        found = [shared.value.features(words_of(text)) for text in texts]
        return pd.Series(shared.value.probability(np.array(found).reshape(-1, shared.value.n_features)))

    return lambda text: probability(utf8(text))


def clean_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    probability = probability_column(docs.sparkSession, fit_on_labels(docs, labels, id_col, text_col))
    return docs.where(probability(F.col(text_col)) < threshold)
