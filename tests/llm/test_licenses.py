"""Phrases and notices against plain searches."""

import random
import time

import pytest
import regex

from tablewright.llm import licenses, queries
from tests.llm.conftest import SF_DIR

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    None,
    "",
    "MIT License",
    "the mit-license and MIT, license; mit license mit license",
    "smit license mit licenses mit the license",
    "Apache License, Version 2.0 and apache license version 20",
    "Licensed under CC BY-NC 4.0.",
    "cc by nc cc by nc cc by nc",
    "Released undr the MTI License by no one",
    "Licenced under the GNU Genral Public License, version 3 or later",
    "naïve mité license ÀÉ mit license",
    "Redistribution and use in source and bynary forms, with or wihout modification",
    "nothing here at all " * 500,
    "mit license " * 3000,
]


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def places(words):
    found = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return found


def plain_rows(texts):
    return {i: (len(words_of(t)), sorted(places(words_of(t)))) for i, t in texts.items()}


def test_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int, label string")
    rows = licenses.scan_licenses(docs).collect()
    want = plain_rows(dict(enumerate(TEXTS)))
    assert {r.doc_id: (r.n_words, sorted((x.first, x.label) for x in r.exact)) for r in rows} == want
    fuzzy = {r.doc_id: {x.label for x in r.fuzzy} for r in rows}
    assert fuzzy[8] == {"mit"} and fuzzy[9] == {"gpl-3"} and fuzzy[11] == {"bsd"}
    assert fuzzy[12] == set() == fuzzy[0]
    span = next(x for r in rows if r.doc_id == 8 for x in r.fuzzy)
    assert (span.first, span.last, span.edits) == (0, 4, 3)
    assert licenses.scan_licenses(docs.limit(0)).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}
    want = plain_rows(texts)
    for r in queries.op5_license_scans(spark, SF_DIR).collect():
        n_words, found = want[r.doc_id]
        starts = [at for at, _ in found]
        assert (r.n_words, r.n_base) == (n_words, len(found))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1 or not found)


@pytest.mark.parametrize("seed", range(30))
def test_seeds_lose_no_match(seed):
    source = random.Random(seed)
    search = licenses.NoticeSearch(licenses.NOTICES)
    notice, _ = source.choice(search.notices)
    number = [n for n, _ in search.notices].index(notice)
    edited = list(notice)
    for _ in range(search.edits[number]):
        at = source.randrange(len(edited))
        edited[at : at + source.randint(0, 1)] = source.choice(["", "x", "q"])
    text = " " + "lorem ipsum " * source.randint(0, 30) + "".join(edited) + " dolor" * source.randint(0, 30) + " "
    whole = search.patterns[number].search(text)
    assert whole is not None
    assert any(n == number for _, _, n, _ in search.matches(text))


def test_worse_notice_before_a_better_one():
    text = " licensed unter the apache licence version 2 licensed under the apache license version 2 "
    search = licenses.NoticeSearch({"licensed under the apache license version 2": "apache-2"})
    assert [(text[start:end].strip(), edits) for start, end, _, edits in search.matches(text)] == [
        ("licensed unter the apache licence version 2", 2),
        ("licensed under the apache license version 2", 0),
    ]


def test_dense_seeds_in_a_long_text():
    source = random.Random(7)
    search = licenses.NoticeSearch(licenses.NOTICES)
    pieces = list(search.seeds.keys())
    hidden = "licensed under the apahce license version 2"
    parts = [source.choice(pieces) for _ in range(120_000)]
    parts[60_000] = hidden
    text = " " + " ".join(parts) + " "
    assert len(text) > 1_000_000
    begin = time.process_time()
    found = search.closest(text)
    assert time.process_time() - begin < 30
    at = text.index(hidden)
    assert any(start <= at + 3 and at + len(hidden) - 3 <= end for start, end, *_ in found)


def test_many_notices_side_by_side():
    search = licenses.NoticeSearch({"licensed under the apache license version 2": "apache-2"})
    words = ["licenced under the apache license versoin 2", "licensed under the apache license version 2"]
    text = " " + " ".join(words * 3000) + " "
    begin = time.process_time()
    found = search.closest(text)
    assert time.process_time() - begin < 20
    assert len(found) == 6000
    assert [edits for *_, edits in found] == [3, 0] * 3000


@pytest.mark.parametrize("seed", range(20))
def test_matches_equal_a_search_of_the_whole_text(seed):
    """The best match anywhere, then the best in what is left on both sides, without seeds or windows."""
    source = random.Random(seed)
    search = licenses.NoticeSearch(licenses.NOTICES)
    number = source.randrange(len(search.notices))
    notice = search.notices[number][0]
    parts = []
    for _ in range(8):
        part = list(notice)
        for _ in range(source.randint(0, search.edits[number] + 2)):
            at = source.randrange(len(part))
            part[at : at + source.randint(0, 1)] = source.choice(["", "x", "q"])
        parts += ["".join(part), *source.sample(notice.split(), 2)]
    text = " " + " ".join(parts) + " "
    wanted, left = [], [(0, len(text))]
    while left:
        start, end = left.pop()
        if match := search.patterns[number].search(text, start, end):
            wanted.append((sum(match.fuzzy_counts), match.start()))
            left += [(start, match.start()), (match.end(), end)]
    got = [(edits, start) for start, _, n, edits in search.matches(text) if n == number]
    assert sorted(edits for edits, _ in got) == sorted(edits for edits, _ in wanted)
    assert all(abs(a - b) <= 3 for (_, a), (_, b) in zip(sorted(got, key=lambda x: x[1]), sorted(wanted, key=lambda x: x[1]), strict=True))


def test_base_phrases_of_the_query(spark, tmp_path):
    """The base phrase is "under the mit license"; "mit license" by itself adds a label and is no base place."""
    texts = {
        1: "mit license here, and there under the MIT License; under the mit-license",
        2: "The MIT License",
        3: "Apache License, Version 2.0, CC BY-NC 4.0, under  the\nmit license",
        4: "under the mitt license cc by ncc",
        5: None,
    }
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op5_license_scans(spark, str(tmp_path)).collect()}
    base = {i: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for i, r in rows.items()}
    assert base == {
        1: (13, 2, 5, 9, "mit"),
        2: (3, 0, None, None, ""),
        3: (14, 3, 0, 10, "apache-2,cc-by-nc,mit"),
        4: (7, 0, None, None, ""),
        5: (0, 0, None, None, ""),
    }
    assert (rows[2].labels, rows[2].score) == ("mit", 1.0) and (rows[5].labels, rows[5].score) == ("", 0.0)
