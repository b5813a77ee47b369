"""Packing and byte-pair encoding against the tokenizers library."""

import gc
import hashlib
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from seawarden.llm import bpe, packing, queries, texts
from tests.llm.conftest import ODD

WORDS, BYTES = queries.tokenizer_path("word_bpe_49k.json"), queries.tokenizer_path("byte_bpe_50k.json")
ALPHABET = [
    "a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "é", "Σ", "ß", "İ", " ", "1", "23", "½", "!", "...", "ſ",
    "<|endoftext|>", "<|startoftext|>", "the", "ing", "\x1c", "\x85", "한국", "😀", "\r\n", "_", "À", "K", "ΑΣ",
    "\u0000", "‍", " \n", "aaaa", " ", " ", "Ⱥ",
]


@pytest.fixture(scope="module")
def odd_texts():
    pick = random.Random(5)
    made = ["".join(pick.choices(ALPHABET, k=pick.randint(0, 14))) for _ in range(3000)]
    return made + ["a" * k for k in range(1, 200, 13)] + ["ab" * 400, "!" * 700, "\n" * 50, " " * 60, "", "=-" * 200]


def test_word_tokenizer_equals_the_library(odd_texts):
    own, whole = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    for text in odd_texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_byte_codec_equals_the_library(odd_texts):
    own, whole = bpe.codec(BYTES), Tokenizer.from_file(BYTES)
    for text in odd_texts:
        ids = own.encode(text)
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert own.decode(ids).decode() == whole.decode(expected, skip_special_tokens=False)


def test_broken_bytes_decode_to_the_replacement_character():
    own, whole = bpe.codec(BYTES), Tokenizer.from_file(BYTES)
    for ids in ([222], [158, 222, 10], [50256, 199]):
        assert own.decode(np.asarray(ids, "<u4").tobytes()).decode() == whole.decode(ids, skip_special_tokens=False)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    known = packing._Memory(lambda key: key * 2)
    assert [known[k % 37] for k in range(500)] == [2 * (k % 37) for k in range(500)]
    assert len(known) <= 10 and len(known.older) <= 10


def test_round_trip_of_whole_texts(docs, odd, nothing, texts_of):
    whole = Tokenizer.from_file(BYTES)

    def expected(doc_id, text):
        ids = whole.encode(text or "", add_special_tokens=False).ids
        raw = whole.decode(ids, skip_special_tokens=False).encode()
        return doc_id, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()

    assert sorted(tuple(r) for r in bpe.round_trip(docs, BYTES).collect()) == sorted(expected(*x) for x in texts_of.items())
    assert sorted(tuple(r) for r in bpe.round_trip(odd, BYTES).collect()) == sorted(expected(*x[:2]) for x in ODD)
    assert bpe.round_trip(nothing, BYTES).count() == 0
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(odd, BYTES), BYTES).collect()}
    assert back == {x[0]: x[1] or "" for x in ODD}


def check_packing(rows, texts, window):
    """Every id in one piece, no window over-full, offsets without gaps."""
    whole = Tokenizer.from_file(WORDS)
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    expected = Counter()
    for doc_id, text in texts:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), window):
            part = ids[start : start + window]
            expected[doc_id, start, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    for held in windows.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert sorted(windows) == list(range(len(windows)))
    return len(windows)


def test_packing(docs, odd, nothing, texts_of):
    rows = packing.pack(docs, WORDS).collect()
    assert check_packing(rows, list(texts_of.items()), 4096) <= -(-sum(r.length for r in rows) // 4096) + 1
    check_packing(packing.pack(odd, WORDS).collect(), [x[:2] for x in ODD], 4096)
    check_packing(packing.pack(odd, WORDS, window=64, part_rows=2).collect(), [x[:2] for x in ODD], 64)
    assert packing.pack(nothing, WORDS).count() == 0


def test_packed_pieces_hold_the_ids_of_their_texts(odd):
    whole = Tokenizer.from_file(WORDS)
    built = defaultdict(list)
    for r in sorted(packing.pack(odd, WORDS, window=64, part_rows=2).collect(), key=lambda r: (r.doc_id, r.start)):
        assert len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.asarray(r.ids, "<u4").tobytes())
        built[r.doc_id].append(r.ids)
    for doc_id, text in {x[0]: x[1] for x in ODD if x[0] != 8}.items():
        assert sum(built[doc_id], []) == [*whole.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("seed", range(6))
def test_rules_are_best_fit_decreasing(seed):
    pick, window = random.Random(seed), 40
    lengths = [pick.choice([1, 2, 3, 7, 7, 7, 13, 20, 21, 39, 40, pick.randint(1, 40)]) for _ in range(pick.randint(1, 400))]
    windows: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [w for w in windows if w >= length]
        if fits:
            windows.remove(min(fits))
            windows.append(min(fits) - length)
        else:
            windows.append(window - length)
    fill = Counter()
    for length, _, count, first, each, offset in packing.best_fit_rules(dict(Counter(lengths)), window):
        for k in range(count):
            fill[first + k // each] += length
            assert offset + (k % each + 1) * length <= window
    assert sorted(window - f for f in fill.values()) == sorted(windows)


def test_a_tokenizer_is_freed_when_it_is_let_go():
    """Workers live on, so a tokenizer must not wait for the collector of cycles."""
    gc.disable()
    try:
        known = packing.WordTokenizer(WORDS)
        assert known.ids("some words, some more")
        gone = weakref.ref(known)
        del known
        assert gone() is None
    finally:
        gc.enable()


def test_ids_are_put_in_a_row_in_stretches(odd_texts):
    known, whole = packing.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    given = [*odd_texts[:300], "one two three " * 50]
    met, got = 0, []
    for first, last, ids, ends in packing.encode(pa.array(given, pa.string()), known, 2, 40):
        assert first == met and len(ids) == ends[-1]
        got += [x.tolist() for x in np.split(ids, ends[:-1])]
        met = last
    assert met == len(given)
    assert got == [[*whole.encode(text, add_special_tokens=False).ids, 2] for text in given]


def test_packing_gets_small_batches_and_leaves_the_setting(spark, monkeypatch):
    seen, real = [], texts.stored
    monkeypatch.setattr(texts, "stored", lambda frame, path: seen.append(spark.conf.get(texts.BATCH_LIMIT)) or real(frame, path))
    rows = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    before = spark.conf.get(texts.BATCH_LIMIT)
    assert packing.pack(rows, WORDS).count() == 2
    assert [int(x.rstrip("b")) for x in seen] == [packing.PART_BYTES]
    assert spark.conf.get(texts.BATCH_LIMIT) == before
