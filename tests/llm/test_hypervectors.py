"""Languages against a plain version, held-out accuracy, and texts with odd letters."""

import zlib

import numpy as np
import pytest

from tablewright.llm import hypervectors, queries
from tests.llm.conftest import SF_DIR


def plain_profile(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return None
    letters = " " + " ".join(words) + " "
    vector = {c: hypervectors._letter_vector(0 if c == " " else ord(c)).astype(int) for c in set(letters)}
    total = np.zeros(hypervectors.DIMENSIONS, int)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        total += np.roll(vector[a], 2) * np.roll(vector[b], 1) * vector[c]
    return total


def plain(rows, learned):
    sums = {}
    for text, lang in learned:
        profile = plain_profile(text)
        if profile is not None and lang is not None:
            sums[lang] = sums.get(lang, 0) + profile
    langs = sorted(sums)
    units = np.array([sums[k] / np.linalg.norm(sums[k]) for k in langs])
    out = []
    for identifier, text in rows:
        profile = plain_profile(text)
        if profile is None or not langs:
            out.append((identifier, "und", 0.0))
        else:
            cosines = units @ (profile / np.linalg.norm(profile))
            out.append((identifier, langs[int(cosines.argmax())], min(1.0, max(0.0, cosines.max()))))
    return out


def same(got, expected):
    got, expected = sorted(got, key=str), sorted(expected, key=str)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert np.allclose([g[2] for g in got], [e[2] for e in expected], atol=1e-5)


def test_query_equals_plain_and_is_right_held_out(spark):
    docs = queries.table(spark, SF_DIR, "documents").select("doc_id", "text", "lang").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs}
    got = queries.op13_language_id(spark, SF_DIR).collect()
    assert all(r.held_out == held[r.doc_id] for r in got)
    expected = plain([(r.doc_id, r.text) for r in docs], [(r.text, r.lang) for r in docs if not held[r.doc_id]])
    same([(r.doc_id, r.lang_pred, r.score) for r in got], expected)
    lang = {r.doc_id: r.lang for r in docs}
    tested = [r for r in got if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in tested]) > 0.98


def test_odd_texts(spark, odd_docs, monkeypatch):
    labelled = spark.createDataFrame(
        [("the and that", "en"), ("der und das", "de"), (None, "xx"), ("123", "yy"), ("word", None), ("", "zz")], "text string, lang string"
    )
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    learned = [tuple(r) for r in labelled.collect()]
    same([tuple(r) for r in hypervectors.predict_languages(odd_docs, labelled).collect()], plain(rows, learned))
    none = hypervectors.predict_languages(odd_docs, labelled.limit(0)).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert hypervectors.predict_languages(odd_docs.limit(0), labelled).count() == 0
    assert hypervectors.held_out_languages(odd_docs).columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_small_caches_change_nothing(monkeypatch):
    grams, counts = np.unique(hypervectors.letter_grams("some words that share letters " * 3 + "日本語 ünï"), return_counts=True)
    whole = hypervectors.GramCache().bundle(grams, counts)
    monkeypatch.setattr(hypervectors, "KEPT_GRAMS", 5)
    cache = hypervectors.GramCache()
    for _ in range(2):
        assert np.array_equal(cache.bundle(grams, counts), whole)
        assert len(cache.known) <= 5


def test_very_long_text(spark):
    labelled = spark.createDataFrame([("the and that", "en"), ("der und das", "de")], "text string, lang string")
    texts = spark.createDataFrame([(1, "der und das " * 400_000), (2, "x" * 3_000_000)], "doc_id long, text string")
    assert hypervectors.predict_languages(texts, labelled).where("doc_id = 1").first().lang_pred == "de"


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(hypervectors, "MAX_LANGUAGES", 3)
    labelled = spark.createDataFrame([("abc", str(k)) for k in range(5)], "text string, lang string")
    with pytest.raises(Exception, match="languages"):
        hypervectors.language_profiles(labelled)
