"""The base score against plain counts; the model as a probability; what it learns."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import mixing_lm, queries
from tests.llm.conftest import SF_DIR


def trained(doc_id):
    return zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % 7 != 2


def check(rows, docs):
    words = [(i, mixing_lm.words_of((t or "").encode())) for i, t in docs]
    counts = Counter(w for i, ws in words if trained(i) for w in ws)
    ends = sum(trained(i) for i, _ in docs)
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    want = Counter()
    for i, ws in words:
        logs = [math.log10((c + 1) / (total + distinct + 1)) for c in [*(counts[w] for w in ws), ends]]
        known = sum(counts[w] > 0 for w in ws) + (ends > 0)
        want[i, not trained(i), len(ws) + 1, known, total, round(sum(logs), 6)] += 1
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == want
    assert all(r.score < 0 for r in rows)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF_DIR, "documents").collect()]
    rows = queries.op3_lm_scoring(spark, SF_DIR).collect()
    check(rows, docs)
    again = {r.doc_id: r.score for r in queries.op3_lm_scoring(spark, SF_DIR).collect()}
    assert {r.doc_id: r.score for r in rows} == pytest.approx(again)


@pytest.mark.parametrize("entries", [131_072, 3])
def test_odd_texts(odd_docs, monkeypatch, entries):
    monkeypatch.setattr(mixing_lm, "TABLE_ENTRIES", entries)
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = mixing_lm.score_texts(odd_docs).collect()
    check(rows, docs)
    assert mixing_lm.score_texts(odd_docs.limit(0)).collect() == []
    check(mixing_lm.score_texts(odd_docs.where("doc_id = 8")).collect(), [d for d in docs if d[0] == 8])


def test_lookup_does_not_change_scores(spark, odd_docs, monkeypatch):
    """Whether words are in the broadcast table or joined makes no difference."""
    docs = odd_docs.where("doc_id > 5").select("doc_id", "text").unionByName(documents(spark).limit(60))
    full = {r.doc_id: (r.score, r.base_score, r.bits_per_byte) for r in mixing_lm.score_texts(docs).collect()}
    monkeypatch.setattr(mixing_lm, "TABLE_ENTRIES", 1)
    monkeypatch.setattr(mixing_lm, "LEAVING", 50)
    few = {r.doc_id: r.score for r in mixing_lm.score_texts(docs).collect()}
    monkeypatch.setattr(mixing_lm, "TABLE_ENTRIES", 131_072)
    assert few == pytest.approx({r.doc_id: r.score for r in mixing_lm.score_texts(docs).collect()}, abs=1e-9)
    assert few.keys() == full.keys() and all(few[k] <= full[k][0] + 1e-9 for k in full)


def documents(spark):
    return queries.table(spark, SF_DIR, "documents").select("doc_id", "text")


def test_partitions_do_not_change_scores(spark, monkeypatch):
    """Weights of several shards, over partitions of any number and order."""
    monkeypatch.setattr(mixing_lm, "SHARD_WORDS", 300)
    docs, given, found = documents(spark), spark.conf.get("spark.sql.shuffle.partitions"), []
    for partitions in (4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rows = mixing_lm.score_texts(docs.repartition(partitions, "text")).collect()
        found.append({r.doc_id: r.score for r in rows})
    spark.conf.set("spark.sql.shuffle.partitions", given)
    assert found[0] == pytest.approx(found[1], rel=0, abs=1e-8)


def test_bits_per_byte(spark):
    rows = [(1, "  a b  a\n\n\n é "), (2, None), (3, "")]
    scored = mixing_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: (r.score, r.bits_per_byte) for r in scored}
    assert found[1][1] == pytest.approx(-found[1][0] / math.log10(2) / len(rows[0][1].encode()))
    assert found[2][1] is found[3][1] is None


def plain_score(docs, held):
    """The score of each text by its own words, from the module's numbers for one word and one bit."""
    texts = [(i, mixing_lm.words_of((t or "").encode())) for i, t in docs]
    counts = Counter(w for i, ws in texts if trained(i) for w in ws)
    ends = sum(trained(i) for i, _ in docs)
    once = mixing_lm.in_mixed_order([w for w, n in counts.items() if n == 1])
    totals = mixing_lm.Totals(sum(counts.values()) + ends, len(counts) + (ends > 0), len(once), ends)
    table = np.zeros((len(mixing_lm.ORDERS), 2 << mixing_lm.SLOT_BITS), "int32")
    mixing_lm.gather_bits(list(counts), np.array(list(counts.values())), table)
    table = table.reshape(len(mixing_lm.ORDERS), -1, 2)
    weights = mixing_lm.learn_weights(once, table, np.full((mixing_lm.GATES, len(mixing_lm.ORDERS)), 1 / len(mixing_lm.ORDERS)))
    leaving = {w for w in sorted(counts, key=lambda w: (-counts[w], w)) if len(w) <= mixing_lm.KEY_BYTES}
    out = {}
    for i, words in texts:
        if i not in held:
            continue
        score, had, flags, taken = totals.end(), Counter(), [], 0.0
        for at, word in enumerate(words):
            flags.append(word not in had)
            if word in had:
                score += math.log10(had[word] / at)
            else:
                spelling = mixing_lm.spelled([word], table, weights) if not counts[word] else np.zeros(1)
                own = float(totals.new(np.array([counts[word]]), spelling)[0])
                score += own - math.log10(1 - taken)
                taken += 10**own if word in leaving else 0.0
            had[word] += 1
        # The end is new as well: the words before it leave it their share.
        out[i] = score - math.log10(1 - taken) + mixing_lm.novelty_cost([np.array([*flags, True])])[0]
    return out


def test_score_against_a_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark).collect()][:80]
    rows = mixing_lm.score_texts(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    held = {i for i, _ in docs[::8]} | {i for i, _ in docs if not trained(i)}
    assert {r.doc_id: r.score for r in rows if r.doc_id in held} == pytest.approx(plain_score(docs, held), rel=1e-6)


def corpus(source, n):
    syllables = ["ba", "ke", "lo", "mi", "nu", "ra"]
    return ["".join(source.choice(syllables, source.integers(1, 5))).encode() for _ in range(n)]


def test_spelling_is_a_probability_and_learns():
    source = np.random.default_rng(1)
    words = sorted(set(corpus(source, 600)))
    table = np.zeros((len(mixing_lm.ORDERS), 2 << mixing_lm.SLOT_BITS), "int32")
    mixing_lm.gather_bits(words, np.ones(len(words), "int64"), table)
    table = table.reshape(len(mixing_lm.ORDERS), -1, 2)
    even = np.full((mixing_lm.GATES, len(mixing_lm.ORDERS)), 1 / len(mixing_lm.ORDERS))
    weights = mixing_lm.learn_weights(words, table, even.copy())
    new = sorted(set(corpus(source, 300)) - set(words))
    like, unlike = mixing_lm.spelled(new, table, weights), mixing_lm.spelled([w[::-1] for w in new], table, weights)
    assert like.mean() > unlike.mean()
    # The probabilities of all one-byte words, and of all longer ones, add up to no more than one.
    single = mixing_lm.spelled([bytes([b]) for b in range(256)], table, weights)
    assert (10.0**single).sum() <= 1 + 1e-9
    assert mixing_lm.spelled([b"x" * 500], table, weights)[0] < -10


def test_novelty_and_repeats():
    rng = np.random.default_rng(2)
    steady = [np.array([True] + [False] * 200), np.array([True] * 200), np.empty(0, bool), rng.random(300) < 0.5]
    cost = mixing_lm.novelty_cost(steady)
    assert cost[2] == 0 and cost[0] > -15 and cost[1] > -15 and -110 < cost[3] < -75
    assert cost == pytest.approx([mixing_lm.novelty_cost([f])[0] for f in steady])
    codes = np.array([0, 1, 0, 0, 2, 1])
    assert list(mixing_lm._first_flags(codes)) == [True, True, False, False, True, False]
    assert mixing_lm.repeat_cost(codes) == pytest.approx(math.log10(1 / 2 * 2 / 3 * 1 / 5))
