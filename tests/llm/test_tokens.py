"""Token counts, byte-level BPE and packing against the libraries applied to whole texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablewright.llm import byte_bpe, packing, queries, token_counts
from tablewright.llm.vocabularies import rank_tokenizer
from tests.llm.conftest import ODD_TEXTS, SF_DIR


def whole(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def sample_texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]


def test_counts_equal_whole_texts(odd_docs):
    tokenizer = whole(token_counts.TOKENIZER)
    for row in token_counts.count_tokens(odd_docs).join(odd_docs.select("doc_id", "text"), "doc_id").collect():
        if row.doc_id == 3:
            continue
        text = row.text or ""
        assert row.n_bytes == len(text.encode())
        assert row.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert token_counts.count_tokens(odd_docs).count() == odd_docs.count()


def test_counts_query_on_real_texts(spark):
    tokenizer = whole(token_counts.TOKENIZER)
    texts = {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}
    for row in queries.op6_token_counts(spark, SF_DIR).collect():
        n = len(tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_tokens, row.over_limit) == (n, n > 2048)


def test_sentencepiece_lengths():
    assert token_counts.encoded_length("piece_bpe_32k.model", b"hello") >= 1


@pytest.mark.parametrize("text", [t or "" for t in ODD_TEXTS])
def test_bpe_round_trip(text):
    encoding = rank_tokenizer(byte_bpe.RANKS)
    ids = byte_bpe.encode(encoding, text)
    assert ids == encoding.encode_ordinary(text)
    assert encoding.decode_bytes(ids) == text.encode()


def test_bpe_parts_of_long_texts(spark, monkeypatch):
    encoding = rank_tokenizer(byte_bpe.RANKS)
    monkeypatch.setattr(byte_bpe, "PART_CHARACTERS", 40)
    for text in sample_texts(spark)[:60] + [t or "" for t in ODD_TEXTS]:
        assert byte_bpe.encode(encoding, text) == encoding.encode_ordinary(text)


@pytest.mark.parametrize("tail", ["", "a", "\n", "1"])
def test_bpe_long_runs_of_white_space(tail, monkeypatch):
    encoding = rank_tokenizer(byte_bpe.RANKS)
    for space in (" ", "\n"):
        text = "x" + space * 20_000 + tail
        assert byte_bpe.encode(encoding, text) == encoding.encode_ordinary(text)
        text = "x" + space * 1_500_000 + tail  # the library alone overflows here
        assert encoding.decode_bytes(byte_bpe.encode(encoding, text)) == text.encode()


def test_bpe_query(spark):
    encoding = rank_tokenizer(byte_bpe.RANKS)
    texts = {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}
    for row in queries.op9_byte_bpe(spark, SF_DIR).collect():
        ids = encoding.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def expected_pieces(rows, capacity=1024):
    tokenizer, found = whole(packing.TOKENIZER), Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            found[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return found


def check_packing(out, rows, capacity=1024):
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out)
    assert got == expected_pieces(rows, capacity)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == len(plain_best_fit([n for places in bins.values() for _, n in places], capacity))


def plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= length
        else:
            rooms.append(capacity - length)
    return rooms


def test_packing_odd_texts(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_packing(packing.pack(odd_docs).collect(), rows)
    check_packing(packing.pack(odd_docs, capacity=16).collect(), rows, 16)


def test_packing_query(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 20)  # many salts
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF_DIR, "documents").collect()]
    check_packing(queries.op10_best_fit_packing(spark, SF_DIR).collect(), rows)


def test_packing_keeps_ids(odd_docs):
    for row in packing.pack(odd_docs, keep_ids=True).collect():
        assert zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32


def test_empty_tables(odd_docs):
    none = odd_docs.limit(0)
    assert packing.pack(none).collect() == []
    assert token_counts.count_tokens(none).collect() == []
    assert byte_bpe.encode_decode(none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=200), st.randoms())
def test_plan_is_best_fit_decreasing(lengths, _):
    capacity = 32
    runs, sequences = packing.best_fit_plan(dict(Counter(lengths)), capacity)
    rooms = plain_best_fit(lengths, capacity)
    assert sequences == len(rooms)
    filled = defaultdict(int)
    for length, count in Counter(lengths).items():
        own = [r for r in runs if r.length == length]
        for rank in range(count):
            run = [r for r in own if r.low <= rank][-1]
            filled[run.first + (rank - run.low) // run.each] += length
    assert sorted(capacity - n for n in filled.values()) == sorted(rooms)


def test_tree_finds_the_tightest():
    tree, opened = packing.CapacityTree(100), set()
    source = random.Random(3)
    for _ in range(2000):
        capacity = source.randint(1, 100)
        is_open = source.random() < 0.3
        (opened.add if is_open else opened.discard)(capacity)
        tree.set(capacity, is_open)
        need = source.randint(1, 100)
        assert tree.tightest(need) == min((c for c in opened if c >= need), default=None)


def test_words_are_encoded_as_the_library_does():
    tokenizer, encoder = packing.json_tokenizer(packing.TOKENIZER), packing.WordIds(packing.TOKENIZER)
    texts = ["a b. c, d! e's f.\nG h\ni.\nJ, k\n\nl m.\n n\u2028o p\x0bq r\rs t.\r\nu", "é ü. ñ\nö x\n y\n", "\nx y.\n", "x .\ny .\n.z 1\n2 a1\nb b\nc2",
             "A.B c-d e- (f) g_ h`\ni <|endoftext|> <s>\n</s> a<|endoftext|>b\nc", "word" * 40 + "\nnext " + "x" * 300, "x'\ny 's\n's don't\nI'll 日\n本 naïve.\nünï"]
    for text in [*texts, *ODD_TEXTS]:
        for _ in range(2):
            expected = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(encoder.of_text(text or ""), "<u4").tolist() == expected, text
