"""License labels: exact phrases, and short notices found with a bounded number of edits.

A notice with at most ``k`` edits, cut into ``k + 1`` pieces, keeps one piece as it is (pigeonhole). The pieces of
all notices are seeds that are searched exactly, all at once. Where one occurs, most of the notice's trigrams have to
stand near their places too: an edit changes at most three of them. Then a window as long as the notice and its edits
is matched by the ``regex`` library within the bound, and the matched span is reported.
"""

from __future__ import annotations

import bisect
import functools
import heapq
from collections.abc import Iterator, Mapping

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import id_type, rows, utf8

#: Phrases whose words stand one after the other, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Shorter phrases that tell a label, too, but are no places of the ones above.
MENTIONS = {"mit license": "mit"}
#: Short notices in normalised form (words and single spaces), with their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2": "apache-2",
    "licensed under the gnu general public license version 2": "gpl-2",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "subject to the terms of the mozilla public license": "mpl-2",
    "licensed under cc by 4": "cc-by",
    "licensed under cc by sa 4": "cc-by-sa",
    "licensed under cc by nc 4": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "all rights reserved by the copyright holder": "all-rights-reserved",
}
#: Characters of a notice for each edit that is allowed in it.
CHARACTERS_PER_EDIT = 10
GRAM = 3

#: ASCII bytes other than digits and letters part words; letters are lower-cased; bytes of other characters stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class Spans:
    """Spans that do not overlap, in order."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, int]] = []

    def overlapped(self, start: int, end: int) -> tuple[int, int] | None:
        """A span that overlaps the given one."""
        at = bisect.bisect_left(self.spans, (end, 0)) - 1
        return self.spans[at] if at >= 0 and self.spans[at][1] > start else None

    def add(self, start: int, end: int) -> None:
        bisect.insort(self.spans, (start, end))


class NoticeSearch:
    """Seeds, trigrams and patterns of a set of notices."""

    def __init__(self, notices: Mapping[str, str]) -> None:
        self.notices = list(notices.items())
        self.edits = [len(notice) // CHARACTERS_PER_EDIT for notice, _ in self.notices]
        self.patterns = [
            regex.compile(f"(?be)(?:{regex.escape(notice)}){{e<={edits}}}")
            for (notice, _), edits in zip(self.notices, self.edits, strict=True)
        ]
        self.grams = [
            [notice[k : k + GRAM] for k in range(len(notice) - GRAM + 1)] for notice, _ in self.notices
        ]
        self.best = functools.lru_cache(maxsize=4096)(self._best)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, _) in enumerate(self.notices):
            pieces = self.edits[number] + 1
            cuts = [len(notice) * k // pieces for k in range(pieces + 1)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(notice[start:stop], []).append((number, stop))
        self.seeds = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.seeds.add_word(seed, uses)
        self.seeds.make_automaton()

    def _best(self, number: int, window: str) -> tuple[int, int, int] | None:
        """(start, end, edits) of the best match in a window."""
        notice = self.notices[number][0]
        at = window.find(notice)
        if at >= 0:
            return at, at + len(notice), 0
        match = self.patterns[number].search(window)
        return match and (match.start(), match.end(), sum(match.fuzzy_counts))

    def has_grams(self, text: str, number: int, begin: int) -> bool:
        """Whether enough trigrams of a notice that would begin at ``begin`` are no further off than edits move them."""
        edits = self.edits[number]
        missing = GRAM * edits
        for place, gram in enumerate(self.grams[number], begin):
            if text.find(gram, max(0, place - edits), max(0, place + edits + GRAM)) < 0:
                missing -= 1
                if missing < 0:
                    return False
        return True

    def windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """For each notice, the windows of ``text`` in which it may stand, by exact seeds and trigrams.

        Seeds that place the notice within an edit's reach of each other share a window, so that none is longer than
        the notice and thrice its edits: too short for two matches side by side.
        """
        begins: dict[int, set[int]] = {}
        for last, uses in self.seeds.iter(text):
            for number, stop in uses:
                begins.setdefault(number, set()).add(last + 1 - stop)
        found: dict[int, list[tuple[int, int]]] = {}
        for number, places in begins.items():
            edits, length = self.edits[number], len(self.notices[number][0])
            groups: list[list[int]] = []
            for begin in sorted(places):
                if not self.has_grams(text, number, begin):
                    continue
                if groups and begin - groups[-1][0] <= edits:
                    groups[-1][1] = begin
                else:
                    groups.append([begin, begin])
            found[number] = [(max(0, low - edits), min(len(text), high + length + edits)) for low, high in groups]
        return found

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of matches: per notice the best one first, then those that do not overlap it."""
        found = []
        for number, windows in self.windows(text).items():
            least = len(self.notices[number][0]) - self.edits[number]
            heap: list[tuple[int, int, int, int, int]] = []
            taken = Spans()

            def offer(low: int, high: int, number=number, least=least, heap=heap) -> None:
                match = self.best(number, text[low:high]) if high - low >= least else None
                if match:
                    heapq.heappush(heap, (match[2], low + match[0], low + match[1], low, high))

            for low, high in windows:
                offer(low, high)
            while heap:
                edits, start, end, low, high = heapq.heappop(heap)
                if other := taken.overlapped(start, end):
                    # What the window has beside the match that was there first.
                    offer(low, min(high, other[0]))
                    offer(max(low, other[1]), high)
                else:
                    taken.add(start, end)
                    found.append((start, end, number, edits))
        return sorted(found)

    def closest(self, text: str) -> list[tuple[int, int, int, int]]:
        """Of matches that overlap, those with the smallest share of edits, and then the longest."""
        ranked = sorted(self.matches(text), key=lambda m: (m[3] / len(self.notices[m[2]][0]), m[0] - m[1], m))
        kept, taken = [], Spans()
        for match in ranked:
            if not taken.overlapped(match[0], match[1]):
                taken.add(match[0], match[1])
                kept.append(match)
        return sorted(kept)


@functools.cache
def notice_search(notices: tuple[tuple[str, str], ...]) -> NoticeSearch:
    return NoticeSearch(dict(notices))


def phrase_places(words: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words (normalised, with a space on both sides) at which the phrase starts."""
    places, number, at = [], 0, 0
    wanted = b" " + phrase + b" "
    found = words.find(wanted)
    while found >= 0:
        number += words.count(b" ", at, found)
        places.append(number)
        at, found = found, words.find(wanted, found + 1)
    return places


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    notices: Mapping[str, str] = NOTICES,
    mentions: Mapping[str, str] = MENTIONS,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``exact``, ``fuzzy`` and ``mentioned``.

    ``exact`` is an array of (first word, last word, label), one per place where a phrase stands, ``mentioned`` the
    same of the mentions; ``fuzzy`` an array
    of (first word, last word, edits, letters, label), one per notice found with at most a tenth of its letters
    edited; of notices that overlap the closest. Words are numbered from 0. A NULL or empty text has none; repeated rows are scanned each; further
    columns are not read.
    """
    listed = tuple(notices.items())
    places = pa.list_(pa.struct({"first": pa.int64(), "last": pa.int64(), "label": pa.string()}))

    def standing(joined: bytes, wanted: Mapping[str, str]) -> list[dict]:
        return [
            {"first": at, "last": at + phrase.count(" "), "label": label}
            for phrase, label in wanted.items()
            for at in phrase_places(joined, phrase.encode())
        ]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = notice_search(listed)
        for batch in batches:
            counts, exact, fuzzy, mentioned = [], [], [], []
            for _, text in rows([batch]):
                words = text.translate(WORD_BYTES).split()
                counts.append(len(words))
                joined = b" " + b" ".join(words) + b" "
                exact.append(standing(joined, phrases))
                mentioned.append(standing(joined, mentions))
                plain = joined.decode("utf-8", "replace")
                near = []
                before, at = -1, 0
                for start, end, number, edits in search.closest(plain):
                    inner = plain[start:end].strip()
                    until = plain.index(inner, start) + 1
                    before, at = before + plain.count(" ", at, until), until
                    first = before
                    notice, label = search.notices[number]
                    last = first + inner.count(" ")
                    near.append({"first": first, "last": last, "edits": edits, "letters": len(notice), "label": label})
                fuzzy.append(near)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(exact, places),
                    pa.array(
                        fuzzy,
                        pa.list_(
                            pa.struct(
                                {
                                    "first": pa.int64(),
                                    "last": pa.int64(),
                                    "edits": pa.int32(),
                                    "letters": pa.int32(),
                                    "label": pa.string(),
                                }
                            )
                        ),
                    ),
                    pa.array(mentioned, places),
                ],
                ["_id", "n_words", "exact", "fuzzy", "mentioned"],
            )

    return (
        docs.select(F.col(id_col).alias("_id"), utf8(F.col(text_col)).alias("_text"))
        .mapInArrow(
            scanned,
            f"_id {id_type(docs, id_col)}, n_words long, exact array<struct<first:long,last:long,label:string>>, "
            "fuzzy array<struct<first:long,last:long,edits:int,letters:int,label:string>>, "
            "mentioned array<struct<first:long,last:long,label:string>>",
        )
        .withColumnRenamed("_id", id_col)
    )
