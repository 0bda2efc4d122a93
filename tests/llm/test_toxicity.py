"""Held-out accuracy, odd rows, and that the ratios are those of a plain computation."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewright.llm import queries, toxicity
from tablewright.llm.common import id_remainder

SYLLABLES = ["ba", "ke", "lo", "mi", "nu", "ra", "ti", "vo"]
BAD = ["grubbish", "wormface", "slugbrain"]


def corpus(n, seed=1):
    source = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(source.choices(SYLLABLES, k=source.randint(1, 4))) for _ in range(source.randint(5, 80))]
        toxic = int(source.random() < 0.25)
        for _ in range(2 * toxic):
            words[source.randrange(len(words))] = source.choice(BAD) + source.choice(["", "s", "est"])
        rows.append((i, " ".join(words) + ".", toxic))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t, _ in rows], "doc_id long, text string, score double, toxic int")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    return docs, labels


def test_held_out_documents(tables):
    docs, labels = tables
    scored = toxicity.score_toxicity(docs, labels).withColumn("held", id_remainder(F.col("doc_id"), 4) == 2)
    rows = scored.join(labels, "doc_id").where("held").collect()
    right = sum((r.score >= toxicity.THRESHOLD) == r.toxic for r in rows)
    assert right >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_with_bigrams(tables):
    docs, labels = tables
    scored = toxicity.score_toxicity(docs, labels, bigrams=True).join(labels, "doc_id").collect()
    assert sum((r.score >= toxicity.THRESHOLD) == r.toxic for r in scored) >= 0.9 * len(scored)


def test_labels_of_held_out_rows_do_not_matter(tables):
    docs, labels = tables
    held = id_remainder(F.col("doc_id"), 4) == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    assert {r.doc_id: r.score for r in toxicity.score_toxicity(docs, turned).collect()} == pytest.approx(first)


def test_odd_rows(odd_docs, tables):
    _, labels = tables
    docs, _ = tables
    both = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    rows = toxicity.score_toxicity(both, labels).collect()
    assert len(rows) == both.count() and all(0 <= r.score <= 1 for r in rows)


def test_without_labels_of_both_classes(odd_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(odd_docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(i, 1) for i in range(10)] + [(None, 0), (11, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(odd_docs, one).collect()} == {1.0}
    assert toxicity.score_toxicity(odd_docs.limit(0), one).collect() == []


def test_ratios_are_kneser_ney(spark):
    rows = [(x, t.encode(), False) for _, t, x in corpus(120, 7)] + [(x, t.encode(), True) for _, t, x in corpus(60, 8)]
    ratios = toxicity.fit_ratios(spark.createDataFrame(rows, "_toxic int, _text binary, _curve boolean"))
    seen = [Counter(), Counter()]
    for x, text, curve in rows:
        if not curve:
            seen[x].update(toxicity.words_of(text))
    types = set(seen[0]) | set(seen[1])

    def level(part, below, under, scale):
        counts = [Counter() for _ in seen]
        for k in (0, 1):
            for word, n in seen[k].items():
                counts[k][part(word)] += n
        out = {}
        for key in counts[0] | counts[1]:
            p = []
            for k in (0, 1):
                total, kinds = sum(counts[k].values()), len(counts[k])
                p.append(max(counts[k][key] - 0.75, 0) / total + 0.75 * kinds / total * below(key)[k] * under(key) / scale(key))
            out[key] = p
        return out

    (long,) = toxicity.BEGINNINGS
    under = Counter(w[:long] for w in types)
    second = level(lambda w: w[:long], lambda k: (1, 1), lambda k: under[k], lambda k: len(types) + 1)
    third = level(lambda w: w, lambda k: second[k[:long]], lambda k: 1, lambda k: under[k[:long]] + 1)
    for word, value in ratios.words.items():
        assert value == pytest.approx(math.log(third[word][1] / third[word][0]), abs=1e-9)
    assert ratios.word(b"slugbrain") > 1 and ratios.word(b"slugbrainless") > 1


def test_query_judges_word_order(spark, tmp_path):
    """Two words that are toxic one after the other alone: no count of single words tells the classes apart."""
    source, rows = random.Random(3), []
    for i in range(800):
        words = ["".join(source.choices(SYLLABLES, k=source.randint(1, 3))) for _ in range(20)]
        toxic = int(source.random() < 0.4)
        for at in (3, 9, 15):
            words[at : at + 2] = ["zub", "grat"] if toxic else ["grat", "zub"]
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.op4_toxicity(spark, str(tmp_path)).where("held_out").collect()
    toxic = {i: x for i, _, x in rows}
    assert len(found) > 100 and sum(r.predicted == toxic[r.doc_id] for r in found) >= 0.95 * len(found)


def test_bigram_ratios_are_kneser_ney(spark):
    rows = [(x, t.encode(), False) for _, t, x in corpus(150, 7)] + [(x, t.encode(), True) for _, t, x in corpus(60, 8)]
    frame = spark.createDataFrame(rows, "_toxic int, _text binary, _curve boolean")
    ratios = toxicity.fit_ratios(frame, bigrams=True)
    texts = [[toxicity.words_of(t) for x, t, curve in rows if x == k and not curve] for k in (0, 1)]
    pairs = [Counter(p for ws in own for p in zip(ws, ws[1:], strict=False)) for own in texts]
    firsts = [Counter(w for ws in own for w in ws) for own in texts]
    follow = [Counter(second for _, second in own) for own in pairs]
    (long,) = toxicity.BEGINNINGS
    types = set(firsts[0]) | set(firsts[1])
    words_under, under = Counter(w[:long] for w in types), Counter(w[:long] for w in follow[0] | follow[1])

    def beginning(key, k):
        counts = Counter()
        for word, n in firsts[k].items():
            counts[word[:long]] += n
        total = sum(counts.values())
        return max(counts[key] - 0.75, 0) / total + 0.75 * len(counts) / total * words_under[key] / (len(types) + 1)

    def lower(word, k):
        total, key = sum(follow[k].values()), word[:long]
        return max(follow[k][word] - 0.75, 0) / total + 0.75 * len(follow[k]) / total * beginning(key, k) / (under[key] + 1)

    kept = {p for p in pairs[0] | pairs[1] if pairs[0][p] + pairs[1][p] > 2}

    def taken(pair, k):
        return max(pairs[k][pair] - 0.75, 0) / (firsts[k][pair[0]] or 1)

    assert len(ratios.bigrams) == len(kept) > 20
    for pair in sorted(kept)[::7]:
        p = []
        for k in (0, 1):
            left = 1 - sum(taken(other, k) for other in kept if other[0] == pair[0])
            p.append(taken(pair, k) + left * lower(pair[1], k))
        assert ratios.bigrams[b" ".join(pair)] == pytest.approx(math.log(p[1] / p[0]), abs=1e-9)
    for word in sorted(follow[0] | follow[1])[::50]:
        assert ratios.continued[word] == pytest.approx(math.log(lower(word, 1) / lower(word, 0)), abs=1e-9)
    words = texts[1][0]
    assert len(ratios.features(words)) == ratios.n_features == 13
