"""Every token goes through the mixer, by what precedes it; a plain version; copies, partitions, odd texts."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablewright.llm import context_mixing as mixing
from tablewright.llm import mixing_lm, queries
from tests.llm.test_mixing_lm import check, trained

SYLLABLES = ["ba", "ke", "lo", "mi", "nu", "ra"]


def corpus(texts=120, seed=1):
    """Sentences of a small grammar: after each word one of three follows; some words occur once."""
    source = np.random.default_rng(seed)
    words = sorted({"".join(source.choice(SYLLABLES, source.integers(1, 4))) for _ in range(60)})
    rows = []
    for number in range(texts):
        at, said = int(source.integers(len(words))), []
        for _ in range(int(source.integers(5, 40))):
            said.append(words[at] if source.random() < 0.95 else f"x{source.integers(10**6)}")
            at = (7 * at + int(source.integers(3))) % len(words)
        rows.append((number, " ".join(said)))
    return rows


def scored(spark, rows, partitions=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return {r.doc_id: r for r in mixing.score_texts(docs).collect()}


def test_what_precedes_a_known_word_counts(spark, tmp_path):
    """The query told texts of known words apart by their words alone: in any order they had one score."""
    rows = [(n, "one two three four five six seven eight") for n in range(40) if trained(n)]
    rows += [(n + 100, "eight three one six") for n in range(8)]
    new = [n for n in range(200, 300) if not trained(n)][:2]
    rows += [(new[0], "one two three four five six"), (new[1], "four one six three five two")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.score for r in queries.op3_lm_scoring(spark, str(tmp_path)).collect() if r.held_out}
    assert found[new[0]] > found[new[1]] + 2


def numbered(rows):
    texts = {i: mixing_lm.words_of(t.encode()) for i, t in rows}
    counts = Counter(w for i, ws in texts.items() if trained(i) for w in ws)
    coded = [w for w in sorted(counts, key=lambda w: (-counts[w], w)) if counts[w] > 1]
    ends = sum(trained(i) for i in texts)
    number = {w: k for k, w in enumerate(coded)}
    rest = sum(counts.values()) - sum(counts[w] for w in coded)
    tree = mixing.huffman([*(counts[w] for w in coded), rest + 1, ends + 1])
    symbols = {i: np.array([*(number.get(w, len(coded)) for w in ws), len(coded) + 1], "int32") for i, ws in texts.items()}
    return texts, counts, coded, tree, symbols


def table_of(texts, tree, bits):
    counts = np.zeros((mixing.HASHED, 2 << bits), "int32")
    mixing.gather(texts, tree, counts)
    return mixing.packed(counts.reshape(mixing.HASHED, -1, 2))


def plain_cost(symbols, tree, table, weights):
    """One text, bit by bit, with dictionaries for what it had before."""
    none, bits, had, total = len(tree.code), table.shape[1].bit_length() - 1, defaultdict(lambda: [0, 0]), 0.0
    before = second = none
    for symbol in symbols.tolist():
        node = tree.root
        one = np.uint64((before + 1) * int(mixing.MULTIPLIERS[0]) % 2**64)
        two = np.uint64((int(one) ^ second) * int(mixing.MULTIPLIERS[2]) % 2**64)
        for depth in range(int(tree.length[symbol])):
            bit = int(tree.code[symbol]) >> (63 - depth) & 1

            def step(pair, chance):
                chance = min(max(chance, 1e-6), 1 - 1e-6)
                zeros, ones = pair[0] + 0.5 * (1 - chance), pair[1] + 0.5 * chance
                return math.log(ones / zeros), ones / (zeros + ones)

            base = chance = float(tree.chance[node])
            inputs, seen = [math.log(base / (1 - base))], []
            for own, context in zip(table, (one, two), strict=True):
                pair = int(own[mixing.slots_of(np.array([context]), np.array([node]), bits)[0]])
                value, chance = step((pair & 0xFFFF, pair >> 16), chance)
                inputs.append(value)
                seen.append((pair & 0xFFFF) + (pair >> 16))
            chance = base
            for key in ((node,), (node, before), (node, before, second)):
                value, chance = step(had[key], chance)
                inputs.append(value)
                if len(key) == 2:
                    seen.append(sum(had[key]))
                had[key][bit] += 1
            levels = [sum(n > k for k in limits) for n, limits in zip(seen, [(0, 2, 15), (0, 2, 15), (0, 2)], strict=True)]
            gate = 12 * levels[1] + 3 * levels[0] + levels[2]
            mixed = min(max(sum(w * x for w, x in zip(weights[:, gate], inputs, strict=True)), -12.0), 12.0)
            total -= math.log10(1 + math.exp(-mixed if bit else mixed))
            node = int(tree.child[node, bit])
        before, second = symbol, before
    return total


def test_score_against_a_plain_version(spark):
    rows = corpus()
    texts, counts, coded, tree, symbols = numbered(rows)
    train = [symbols[i] for i in symbols if trained(i)]
    totals = mixing_lm.Totals(sum(map(len, train)), len(counts) + 1, sum(n == 1 for n in counts.values()), len(train))
    bits = (4 * totals.tokens).bit_length()
    table = table_of(train, tree, bits)
    train.sort(key=lambda x: (mixing.xxhash.xxh64_intdigest(x.tobytes()), x.tobytes()))
    weights = mixing.learn(train, np.ones(len(train)), tree, table)
    once = mixing_lm.in_mixed_order([w for w, n in counts.items() if n == 1])
    bytes_ = np.zeros((len(mixing_lm.ORDERS), 2 << mixing_lm.SLOT_BITS), "int32")
    mixing_lm.gather_bits(list(counts), np.array(list(counts.values())), bytes_)
    bytes_ = bytes_.reshape(len(mixing_lm.ORDERS), -1, 2)
    even = np.full((mixing_lm.GATES, len(mixing_lm.ORDERS)), 1 / len(mixing_lm.ORDERS))
    spelling = mixing_lm.learn_weights(once, bytes_, even)
    want = {}
    for i, words in texts.items():
        had, flags, score = Counter(), [], plain_cost(symbols[i], tree, table, weights)
        for word in words:
            if word not in coded:
                flags.append(word not in had)
                score += math.log10(had[word] / had.total()) if had[word] else mixing_lm.spelled([word], bytes_, spelling)[0]
                had[word] += 1
        want[i] = score + mixing_lm.novelty_cost([np.array(flags, bool)])[0]
    assert {i: r.score for i, r in scored(spark, rows).items()} == pytest.approx(want, rel=1e-4)


def test_partitions_shards_and_lookup_do_not_change_scores(spark, monkeypatch):
    rows = corpus(80, 2) + corpus(20, 2)
    rows = [(n, text) for n, (_, text) in enumerate(rows)]
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 500)
    given, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for partitions, entries in ((4, 65_536), (16, 1)):
        monkeypatch.setattr(mixing, "TABLE_ENTRIES", entries)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append({i: r.score for i, r in scored(spark, rows, partitions).items()})
    spark.conf.set("spark.sql.shuffle.partitions", given)
    assert found[0] == pytest.approx(found[1], rel=0, abs=1e-8)


def test_odd_texts(odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(mixing.score_texts(odd_docs).collect(), docs)
    assert mixing.score_texts(odd_docs.limit(0)).collect() == []
    none = odd_docs.where("pmod(crc32(cast(doc_id as string)), 7) = 2")
    assert none.count()
    check(mixing.score_texts(none).collect(), [d for d in docs if d[0] is not None and not trained(d[0])])


def test_places_are_probabilities_and_copies_count():
    _, _, coded, tree, symbols = numbered(corpus())
    train = [symbols[i] for i in symbols if trained(i)]
    table, ones = table_of(train, tree, 12), np.ones(len(train))
    weights = mixing.learn(train, ones, tree, table)
    start = train[0][:4]
    each = [np.append(start, np.int32(k)) for k in range(len(tree.code))]
    follows = mixing.costs(each, tree, table, weights) - mixing.costs([start], tree, table, weights)
    assert (10.0**follows).sum() == pytest.approx(1)
    # Held out, the learned weights beat those that they start from.
    held = [symbols[i] for i in symbols if not trained(i)]
    assert mixing.costs(held, tree, table, weights).sum() > mixing.costs(held, tree, table, mixing.even_weights()).sum()
    twice = mixing.learn(train[:5] + train[:5], np.ones(10), tree, table)
    assert mixing.learn(train[:5], np.full(5, 2), tree, table) == pytest.approx(twice, abs=1e-6)


def test_texts_of_one_batch_do_not_see_each_other():
    _, _, _, tree, symbols = numbered(corpus())
    texts = list(symbols.values())
    table = table_of(texts[:50], tree, 12)
    apart = [mixing.costs([text], tree, table, mixing.even_weights())[0] for text in texts]
    assert mixing.costs(texts, tree, table, mixing.even_weights()) == pytest.approx(apart, abs=1e-4)


def test_large_counts_keep_their_ratio():
    counts = np.array([[[3, 65_535], [0, 65_536], [2**31 - 1, 2**30], [0, 0]]], "int32")
    table = mixing.packed(counts)[0]
    assert [(int(x) & 0xFFFF, int(x) >> 16) for x in table] == [(3, 65_535), (0, 32_768), (65_535, 32_768), (0, 0)]
    back = mixing_lm.from_significance(mixing_lm.by_significance(np.array([1, 256, 70_000, 2**31 - 1], "int32")))
    assert back.tolist() == [1, 256, 70_000, 2**31 - 1]


def test_count_blocks_are_smaller_than_a_shuffle_makes_them():
    """Blocks of counts took most of the scratch disk: the codec of a shuffle does not shorten frequent bytes."""
    counts = np.random.default_rng(3).poisson(2, mixing_lm.BLOCK_SLOTS).astype("int32")
    planes = np.ascontiguousarray(counts.view("uint8").reshape(-1, 4).T)
    block = mixing_lm.by_significance(counts)
    assert len(block) < 0.6 * len(mixing.pa.compress(planes, "lz4", asbytes=True))
    assert mixing_lm.from_significance(block).tolist() == counts.tolist()


def test_words_of_many_texts_at_once():
    texts = [b"", b"  a\x0b\x0cB\x1cc\x85 ", b"\xff\xfe x\xc2\xa0Y", "Ä ä".encode(), b" \n ", b"A\tb\r\nC"]
    for start in range(len(texts) + 1):
        own = texts[start:]
        words, sizes = mixing_lm.split_words(mixing.pa.array(texts, mixing.pa.binary()).slice(start))
        assert words.to_pylist() == [word for text in own for word in mixing_lm.words_of(text)]
        assert sizes.tolist() == [len(mixing_lm.words_of(text)) for text in own]


def test_history_counts_what_came_before():
    _, _, _, tree, symbols = numbered(corpus(6))
    tokens = mixing.stream(list(symbols.values()), tree)
    place = np.empty(len(tokens.order), "int64")
    place[tokens.order] = np.arange(len(place))
    for key in tokens.keys:
        history, had, began = mixing.History(key, place, True), Counter(), [()] * len(place)
        for _, bit in mixing.walked(tokens, tree):
            before, same, every, alike = history.step(bit.astype(bool))
            for part, whole in ((before, every), (same, alike)):
                had.clear()
                for at in range(len(place)):
                    if place[at] < len(bit):
                        group = key[at], began[at]
                        assert part[place[at]] == had[group]
                        had[group] += 1
                assert all(whole[place[at]] == had[key[at], began[at]] for at in range(len(place)) if place[at] < len(bit))
                if part is before:
                    began = [own + (int(bit[p]),) if p < len(bit) else own for own, p in zip(began, place, strict=True)]


def test_slices_of_a_batch_do_not_change_scores(spark, monkeypatch):
    rows = corpus(40, 4)
    whole = {i: r.score for i, r in scored(spark, rows).items()}
    monkeypatch.setattr(mixing, "SLICE", 100)
    monkeypatch.setattr(mixing_lm, "SLICE", 100)
    assert {i: r.score for i, r in scored(spark, rows).items()} == pytest.approx(whole, rel=1e-9)
