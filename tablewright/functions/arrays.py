"""Array functions."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.chance import hash_number


def array_choice(array: Column, *keys: Column, seed: int | None = None) -> Column:
    """One uniformly drawn element; NULL elements can be drawn.

    With ``seed`` and ``keys`` the draw repeats for the same key; without a seed it is
    new in every run.  An empty or NULL array gives NULL.
    """
    size = F.size(array)
    if seed is None:
        position = F.floor(F.rand() * size)
    else:
        if not keys:
            raise ValueError("a seeded choice needs at least one key column")
        position = hash_number(seed, keys) % F.nullif(size, F.lit(0))
    return F.get(array, position.cast("int"))


def choice_of_columns(cols: Sequence[Column], *keys: Column, seed: int | None = None) -> Column:
    """One of the columns' values; a NULL value can be drawn."""
    return array_choice(F.array(*cols), *keys, seed=seed)


def choice_of_values(values: Sequence[object], *keys: Column, seed: int | None = None) -> Column:
    """One of the given literals."""
    return array_choice(F.array(*(F.lit(v) for v in values)), *keys, seed=seed)


def array_mean(array: Column) -> Column:
    """Mean of the elements; NULL for an empty array or one with a NULL element."""
    return F.aggregate(
        array,
        F.lit(0.0),
        lambda total, x: total + x.cast("double"),
        lambda total: F.try_divide(total, F.size(array).cast("double")),
    )


def array_all(array: Column, predicate: Callable[[Column], Column]) -> Column:
    """Whether every element satisfies the predicate."""
    return F.forall(array, predicate)


def array_all_at_least(array: Column, threshold: int | float = 1) -> Column:
    return array_all(array, lambda x: x >= F.lit(threshold))


def _naming(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _tallied(entries: Column) -> Column:
    """Entries (``key``, ``n``) in the order of their keys, those of one key added up."""

    def tally(sorted_entries: Column) -> Column:
        size = F.size(sorted_entries)
        places = F.transform(sorted_entries, lambda e, i: i)

        def first(i: Column) -> Column:
            return (i == 0) | (F.get(sorted_entries, i)["key"] != F.get(sorted_entries, i - 1)["key"])

        def added(starts: Column) -> Column:
            def run(start: Column, j: Column) -> Column:
                length = F.coalesce(F.get(starts, j + 1), size) - start
                total = F.aggregate(F.slice(sorted_entries, start + 1, length), F.lit(0), lambda n, e: n + e["n"])
                return F.struct(F.get(sorted_entries, start)["key"].alias("key"), total.alias("n"))

            return F.transform(starts, run)

        return _naming(F.filter(places, first), added)

    return _naming(entries, tally)


def _keyword_index(topics: Sequence[Sequence[str]]) -> tuple[Callable[[Column], Column], Column]:
    """How to find a keyword's number, and the keywords' topics, as text.

    The keywords are a literal array of buckets, a keyword being in that of its CRC. There are twice as many buckets as
    keywords, so it meets few others whatever their number.
    """
    numbers: dict[str, list[int]] = {}
    for number, words in enumerate(topics):
        for word in dict.fromkeys(words):
            numbers.setdefault(word, []).append(number)
    used = {c for word in numbers for c in word}
    # Characters that no keyword has, from a range for private use.
    between, entry, mark = itertools.islice((chr(c) for c in range(0xE000, 0xF8FF) if chr(c) not in used), 3)
    buckets: list[list[str]] = [[] for _ in range(2 * len(numbers) + 1)]
    for place, word in enumerate(numbers):
        buckets[zlib.crc32(word.encode()) % len(buckets)].append(f"{word}{mark}{place}")
    table = F.split(F.lit(between.join(entry.join(b) for b in buckets)), between, -1)
    listed = F.split(F.lit(between.join(",".join(map(str, t)) for t in numbers.values())), between, -1)

    def found(token: Column) -> Column:
        bucket = F.get(table, F.pmod(F.crc32(token.cast("binary")), F.lit(len(buckets))).cast("int"))
        wanted = F.concat(token, F.lit(mark))
        one = F.get(F.filter(F.split(bucket, entry), lambda e: e.startswith(wanted)), F.lit(0))
        return F.substring_index(one, mark, -1).cast("int")

    return found, listed


# Up to so many topics it is cheaper to count the hits of each than to go by an index; the counts are the same.
FEW_TOPICS = 16


def keyword_hits(tokens: Column, topics: Sequence[Sequence[str]]) -> Column:
    """One count per topic, in the order of ``topics``: how many tokens are among its keywords, repeats counted.

    Every token is looked for once in the set of all keywords. Hits are added up per keyword, and then per topic by an
    index of the keywords, so the cost follows the tokens, the topics of the different keywords among them, and the
    length of the result. A keyword
    that a topic names twice counts once per token.
    """
    if not topics:
        return F.array().cast("array<int>")
    every = sorted({word for words in topics for word in words})
    kept = F.filter(tokens, lambda token: token.isin(every))
    if len(topics) <= FEW_TOPICS:
        return _naming(
            kept, lambda hit: F.array(*(F.size(F.filter(hit, lambda token: token.isin(*words))) for words in topics))
        )
    keywords = _tallied(F.transform(F.sort_array(kept), lambda word: F.struct(word.alias("key"), F.lit(1).alias("n"))))

    found, listed = _keyword_index(topics)

    def of_topics(keyword: Column) -> Column:
        numbers = F.split(F.get(listed, found(keyword["key"])), ",").cast("array<int>")
        return F.transform(numbers, lambda t: F.struct(t.alias("key"), keyword["n"].alias("n")))

    def dense(counts: Column) -> Column:
        def with_zeros(entry: Column, i: Column) -> Column:
            before = F.coalesce(F.get(counts, i - 1)["key"], F.lit(-1))
            return F.concat(F.array_repeat(F.lit(0), entry["key"] - before - 1), F.array(entry["n"]))

        last = F.coalesce(F.get(counts, F.size(counts) - 1)["key"], F.lit(-1))
        return F.concat(
            F.flatten(F.transform(counts, with_zeros)), F.array_repeat(F.lit(0), F.lit(len(topics) - 1) - last)
        )

    hits = _naming(_tallied(F.sort_array(F.flatten(F.transform(keywords, of_topics)))), dense)
    return F.when(tokens.isNull(), F.array_repeat(F.lit(None).cast("int"), len(topics))).otherwise(hits)
