"""Byte-level BPE by backtracking over longest matches, and decoding by an offset table.

The encoder never runs merges. An Aho-Corasick automaton over the vocabulary gives the longest token at each
position. Tokens are taken greedily; two neighbours may stand side by side only if BPE itself would not merge
across their border, which a table of pairs answers. Where no token fits, the encoder steps back and marks the
position as dead, so each position is tried a bounded number of times.

Defined cases: a null text is empty and gives no ids; strings of special tokens in a text become their ids;
repeated rows give repeated results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawarden.llm import texts
from seawarden.llm.packing import _Memory, byte_letters, in_letters

#: Letters and numbers up to U+024F, and the white space among them.
_LATIN, _DIGITS, _WHITE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
_LATIN_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[{_DIGITS}]+| ?[^{_WHITE}{_DIGITS}{_LATIN}]+"
    f"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
#: A blank that may not begin a new unit, see ``Codec.units``.
_BLANK_RUN = re.compile(r" (?=\s|\Z)")
#: Border pairs that a worker remembers.
PAIRS = 1 << 18


class Codec:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.vocabulary: dict[str, int] = stored["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in stored["model"]["merges"]]
        self.rank = {pair: rank for rank, pair in enumerate(merges)}
        self.halves: dict[str, tuple[str, str]] = {}
        for left, right in merges:
            self.halves.setdefault(left + right, (left, right))
        self.borders: dict[tuple[str, str], bool] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for token in sorted(self.vocabulary, key=len):
            if len(token) == 1 or token in self.halves and self.fits(*self.halves[token], joined=True):
                self.automaton.add_word(token)
        self.automaton.make_automaton()
        #: The longest token that is a proper prefix of each token.
        self.shorter = {token: self._shorter(token) for token in self.automaton}
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        back = {letter: byte for byte, letter in enumerate(byte_letters())}
        count = max([*self.vocabulary.values(), *self.special.values()]) + 1
        raw = [b""] * count
        for token, i in self.vocabulary.items():
            raw[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            raw[i] = token.encode()
        #: All tokens' bytes in a row, and where each token's bytes begin: the decoder's offset table.
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.offsets = np.cumsum([0, *map(len, raw)])
        self.pieces = _Memory(lambda piece: np.asarray(self.backtrack(piece), "<u4").tobytes())
        self.after_blank = _Memory(lambda rest: self.unit(" " + rest))

    # --- the pair table --------------------------------------------------------------------------

    def _edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """The symbols that stand at one edge of a token while it is merged, each with the rank that ends it."""
        edge, ends = [], float("inf")
        while True:
            edge.append((token, ends))
            if token not in self.halves:
                return edge
            ends = self.rank[self.halves[token]]
            token = self.halves[token][side]

    def fits(self, left: str, right: str, joined: bool = False) -> bool:
        """Whether merging never crosses the border of the two. ``joined``: whether it only does so at the end."""
        last = self.rank[left, right] if joined else float("inf")
        for x, x_ends in self._edge(left, 1):
            for y, y_ends in self._edge(right, 0):
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_ends and rank <= y_ends and rank < last:
                    return False
        return True

    # --- encoding --------------------------------------------------------------------------------

    def _shorter(self, token: str) -> str | None:
        for end in range(len(token) - 1, 0, -1):
            if token[:end] in self.automaton:
                return token[:end]
        return None

    def backtrack(self, piece: str) -> list[int]:
        """Ids of one pre-token, given as byte letters."""
        longest = {end + 1 - size: piece[end + 1 - size : end + 1] for end, size in self.automaton.iter(piece)}
        borders, shorter, size = self.borders, self.shorter, len(piece)
        taken, last, dead = [], "", set()
        at, token = 0, longest.get(0)
        while at < size:
            while token is not None:
                if at + len(token) not in dead:
                    if not last:
                        break
                    fits = borders.get((last, token))
                    if fits is None:
                        fits = self._remember(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token is None:
                dead.add(at)
                at -= len(last)
                token = shorter[taken.pop()]
                last = taken[-1] if taken else ""
            else:
                taken.append(token)
                at += len(token)
                last, token = token, longest.get(at)
        return [self.vocabulary[token] for token in taken]

    def _remember(self, left: str, right: str) -> bool:
        if len(self.borders) >= PAIRS:
            self.borders.clear()
        fits = self.borders[left, right] = self.fits(left, right)
        return fits

    def unit(self, unit: str) -> bytes:
        known = self.pieces
        if unit.isascii() and unit.isprintable():
            return b"".join([known[piece.replace(" ", "Ġ")] for piece in _LATIN_PIECES.findall(unit)])
        if not _BEYOND_LATIN.search(unit):
            return b"".join([known[in_letters(piece)] for piece in _LATIN_PIECES.findall(unit)])
        return b"".join([known[piece] for piece, _ in self.split(unit)])

    def units(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A blank always belongs to what follows it, unless more white space or the end follows. If no blank is
        like that, the text parts before every blank into units that are encoded one by one and remembered.
        """
        if _BLANK_RUN.search(text):
            return self.unit(text)
        first, *rest = text.split(" ")
        return self.unit(first) + b"".join(map(self.after_blank.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if self.special_split is None or not any(token in text for token in self.special):
            return self.units(text)
        out = []
        for part in self.special_split.split(text):
            if part in self.special:
                out.append(np.asarray([self.special[part]], "<u4").tobytes())
            elif part:
                out.append(self.units(part))
        return b"".join(out)

    # --- decoding --------------------------------------------------------------------------------

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes of ids; broken sequences become the replacement character."""
        tokens = np.frombuffer(ids, "<u4")
        starts, sizes = self.offsets[tokens], self.offsets[tokens + 1] - self.offsets[tokens]
        total = int(sizes.sum())
        shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        raw = self.blob[shift + np.arange(total)].tobytes()
        return raw.decode("utf-8", "replace").encode()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of each document's whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        ids = [np.frombuffer(own.encode(text.as_py() or ""), "<u4").astype(np.int32) for text in batch["text"]]
        return texts.table(None, {"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.list_(pa.int32()))})

    return texts.per_batch(texts.ids_and_texts(docs), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of each list of ids; null ids give an empty text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        out = [own.decode(np.asarray(ids.as_py() or [], "<u4").tobytes()).decode() for ids in batch["ids"]]
        return texts.table(None, {"doc_id": batch["doc_id"], "text": pa.array(out, pa.string())})

    narrow = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return texts.per_batch(narrow, run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of each document's ids, and the digest of the text decoded from them."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        counts, ids_digest, text_digest = [], [], []
        for text in batch["text"]:
            ids = own.encode(text.as_py() or "")
            counts.append(len(ids) // 4)
            ids_digest.append(hashlib.sha256(ids).hexdigest())
            text_digest.append(hashlib.sha256(own.decode(ids)).hexdigest())
        columns = {
            "doc_id": batch["doc_id"],
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(ids_digest, pa.string()),
            "decoded_sha256": pa.array(text_digest, pa.string()),
        }
        return texts.table(None, columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts.per_batch(texts.ids_and_texts(docs), run, schema)
