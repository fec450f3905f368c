"""BPE encoding and decoding with a contiguous rank array.

A word is an array of part ids and an array of the ranks of adjacent parts. The smallest rank is looked for again and
again (the leftmost of equals), the boundary under it goes, and the two ranks beside it are looked up anew. For short
words such scans beat any queue; words of more than `LONG` parts, where scans would cost their square, use a heap
with the same order.

The text form is that of a word-end tokenizer: NFC, lower case, white space dropped, byte symbols, a mark on the last
symbol of a word. Special tokens are found in the raw text. Decoding joins token texts with a space, as a tokenizer
file without decoder does. Null and empty texts have no ids and decode to an empty text.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import unicodedata
from array import array

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from tagloom.llm.common import LONG_KEY, Generations, per_text

LONG = 200
#: Chunks in one generation of what a worker remembers.
REMEMBERED = 200_000
_NO_RANK = 1 << 60

#: Fixed value: the tokenizer file's split pattern, with its white space spelled out.
_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r\x20\x85\p{Z}\p{L}\p{N}]+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class WordBpe:
    """The tokenizer of a file: `encode`, `decode`, and `chunk` for one piece of text without white space inside."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.inner = [vocab[s] for s in byte_symbols()]
        self.last = [vocab[s + suffix] for s in byte_symbols()]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        if not all("<" in t for t in self.special):
            raise ValueError("a special token without '<'")
        self._words = Generations(100_000)

    def merge(self, parts: list[int]) -> list[int]:
        """The ids of a word given as symbol ids."""
        if len(parts) > LONG:
            return self._merge_long(parts)
        get = self.ranks.get
        ranks = [get(a << 32 | b, _NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NO_RANK:
                break
            at = ranks.index(least)
            parts[at] = self.merged[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] << 32 | parts[at], _NO_RANK)
            if at < len(ranks):
                ranks[at] = get(parts[at] << 32 | parts[at + 1], _NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, get = len(parts), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, at = heapq.heappop(queue)
            right = after[at]
            if parts[at] < 0 or right >= n or get(parts[at] << 32 | parts[right]) != rank:
                continue
            parts[at], parts[right] = self.merged[rank], -1
            after[at] = follow = after[right]
            if follow < n:
                before[follow] = at
                if (r := get(parts[at] << 32 | parts[follow])) is not None:
                    heapq.heappush(queue, (r, at))
            if (left := before[at]) >= 0 and (r := get(parts[left] << 32 | parts[at])) is not None:
                heapq.heappush(queue, (r, left))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> list[int]:
        """The ids of a word, remembered."""
        known = self._words.young.get(word)
        if known is None:
            known = self._words.old.get(word)
            if known is None:
                raw = word.encode()
                inner = self.inner
                parts = [inner[b] for b in raw]
                parts[-1] = self.last[raw[-1]]
                known = self.merge(parts)
            if len(word) <= LONG_KEY:
                self._words.turned()[word] = known
        return known

    def chunk(self, text: str) -> list[int]:
        """The ids of a text; correct for whole texts, and piece by piece for pieces cut at white space."""
        if "<" not in text:  # as all special tokens have
            return self._plain(text)
        ids: list[int] = []
        at = 0
        for m in self._special.finditer(text):
            ids += self._plain(text[at : m.start()])
            ids.append(self.special[m[0]])
            at = m.end()
        return ids + self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        if not text.isascii():
            # each capital sigma alone, whatever follows it
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isalpha() and text.isascii():
            return self.word(text)
        return [i for word in _SPLIT.findall(text) for i in self.word(word)]

    def encode(self, text: str) -> list[int]:
        return self.chunk(text)

    def decode(self, ids) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def _as_bytes(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if packed.itemsize != 4:
        raise TypeError("unsigned int has not 4 bytes here")
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


@functools.lru_cache(maxsize=2)
def _chunks(path: str) -> Generations:
    """Chunk (UTF-8) to its ids as little-endian unsigned 32-bit integers."""
    return Generations(REMEMBERED)


def _encoder(path: str):
    """A function of a text in UTF-8: its ids as little-endian unsigned 32-bit integers."""
    bpe, memory = tokenizer(path), _chunks(path)

    def encode(raw: bytes) -> bytes:
        chunks = raw.split()
        known = memory.turned()
        for chunk in set(chunks).difference(known):
            ids = memory.old.get(chunk)
            known[chunk] = _as_bytes(bpe.chunk(chunk.decode("utf-8", "replace"))) if ids is None else ids
        ids = b"".join(map(known.__getitem__, chunks))
        memory.forget_long()
        return ids

    return encode


def encode(
    docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """`keep` with ids (binary, little-endian unsigned 32-bit integers) and n_tokens of each whole text."""
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def factory():
        made = _encoder(path)

        def ids_of(raw: bytes) -> tuple:
            ids = made(raw)
            return ids, len(ids) // 4

        return ids_of

    return per_text(docs, factory, "ids binary, n_tokens long", keep, text)


def encode_decode(
    docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """The result of `encode` and decoded.

    ASCII white space separates chunks no word can cross, so a worker remembers what frequent chunks give.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def factory():
        made, bpe = _encoder(path), tokenizer(path)

        def both(raw: bytes) -> tuple:
            ids = made(raw)
            return ids, len(ids) // 4, bpe.decode(np.frombuffer(ids, "<u4").tolist())

        return both

    return per_text(docs, factory, "ids binary, n_tokens long, decoded string", keep, text)
