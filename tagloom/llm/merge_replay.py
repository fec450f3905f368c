"""Byte-level BPE by replaying the merges over all words of a block at once.

The distinct words of a block of texts lie one after the other in one array of parts, linked to their neighbours. An
inverted index leads from the rank of a token pair to the positions where the pair stands. The merges are applied in
rank order, each at all its positions together; a merge touches only the pairs beside it, whose new ranks go into the
index. Where a merge gives a pair of a lower rank than its own (the same bytes can be reached by other splits), the
rest of that word waits until the lower pair is done, so that every word sees its merges in exactly the order of a
word-by-word encoder: least rank first, the leftmost of equals.

A word that is itself a token is that token. Words are the matches of the split pattern; texts are cut at single spaces
first, where no match can cross, so that a worker looks at each distinct chunk once in a block. Null and empty texts
have no ids and decode to no bytes; repeated rows give repeated rows; an empty table gives none. A very long text is
read in pieces cut where no token can cross; a very long single word takes about 50 bytes of memory for each of its own.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagloom.llm.token_counts import PIECE_CHARS, pieces

#: UTF-8 bytes of text that make a block.
BLOCK_BYTES = 16 << 20
#: Estimated bytes of chunks not seen before after which a block ends early, and of all remembered chunks, and words,
#: after which a worker starts to remember anew.
NEW_BYTES, KNOWN_BYTES = 64 << 20, 64 << 20
#: What a remembered chunk or word takes beside its text and ids.
ENTRY_BYTES = 150
_NONE = np.int32(2**31 - 1)
_DEAD = np.int32(-1)
#: A space with white space on both sides, or before the end: no place to cut.
_UNSAFE, _UNSAFE_ASCII = re.compile(r"\s (?:\s|\Z)"), re.compile(rb"\s (?:\s|\Z)")


class Replay:
    """The encoder of a rank file: `words` for many words at once, `token_bytes` by id."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.size = max(self.ranks.values()) + 1
        self.token_bytes: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            self.token_bytes[rank] = token
        self.bytes_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        get, found = self.ranks.get, []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    found.append((a * (self.size + 1) + b, rank))
        found.sort()
        # one key beyond all others, so that every search ends inside the array
        self._keys = np.array([k for k, _ in found] + [2**62], dtype=np.int64)
        self._ranks = np.array([r for _, r in found] + [_NONE], dtype=np.int32)
        left, right = self._keys[:-1] // (self.size + 1), self._keys[:-1] % (self.size + 1)
        # tokens that can stand in a pair of lower rank than their own
        self._falls = np.zeros(self.size, dtype=bool)
        for part in (left, right):
            self._falls[part[self._ranks[:-1] < part]] = True

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; the token `size` stands for the end of a word and is in no pair."""
        keys = a.astype(np.int64) * (self.size + 1) + b
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._ranks[at], _NONE)

    def words(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of each non-empty word, as little-endian 32-bit integers."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(data)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        # the place n stands beyond either end of every word
        token = np.append(self.bytes_ids[data], np.int32(self.size))
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        after[ends - 1] = n
        before[0] = n
        before[ends[:-1]] = n
        rank = np.append(self.pair_ranks(token[:n], token[after[:n]]), _DEAD)

        order = np.argsort(rank[:n], kind="stable").astype(np.int32)
        first_ranks, starts = np.unique(rank[order], return_index=True)
        bounds = np.append(starts, n).tolist()
        todo = [r for r in first_ranks.tolist() if r != _NONE]
        index: dict[int, list[int]] = {}  # what has come since
        queue: list[int] = []
        at = 0
        while at < len(todo) or queue:
            r = min(todo[at] if at < len(todo) else _NONE, queue[0] if queue else _NONE)
            found = order[:0]
            if at < len(todo) and todo[at] == r:
                found = order[bounds[at] : bounds[at + 1]]
                at += 1
            if queue and queue[0] == r:
                heapq.heappop(queue)
                found = np.sort(np.concatenate([found, np.array(index.pop(r), dtype=np.int32)]))
            found = found[rank[found] == r]
            if not len(found):
                continue
            chosen = self._without_overlap(found, after)
            if self._falls[r]:
                chosen = self._until_fall(chosen, r, token, after, before, ends)
            gone = after[chosen]
            follow = after[gone]
            token[chosen], token[gone], rank[gone] = r, _DEAD, _DEAD
            after[chosen], before[follow] = follow, chosen
            lead = before[chosen]
            touched = lead < n
            touched[1:] &= lead[1:] != chosen[:-1]  # that pair is the right one of the merge before
            beside = np.concatenate([chosen, lead[touched]])
            new = self.pair_ranks(token[beside], token[after[beside]])
            rank[beside] = new
            some = new != _NONE
            arrived = list(zip(new[some].tolist(), beside[some].tolist()))
            if self._falls[r]:
                arrived += [(r, p) for p in found[rank[found] == r].tolist()]
            for k, p in arrived:
                known = index.get(k)
                if known is None:
                    index[k] = [p]
                    heapq.heappush(queue, k)
                else:
                    known.append(p)
        alive = token[:n] != _DEAD
        ids = token[:n][alive].astype("<i4").tobytes()
        cuts = (4 * np.cumsum(alive, dtype=np.int64)[ends - 1]).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    @staticmethod
    def _without_overlap(found: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of each run of positions that follow one another every second one, from the left."""
        joined = after[found[:-1]] == found[1:]
        if not joined.any():
            return found
        place = np.arange(len(found))
        run_start = np.maximum.accumulate(np.where(np.append(False, joined), 0, place))
        return found[(place - run_start) % 2 == 0]

    def _until_fall(self, chosen, r, token, after, before, ends) -> np.ndarray:
        """The merges of each word up to the first that gives a pair of lower rank, as if done one by one."""
        gone = after[chosen]
        left = token[before[chosen]]
        left[1:][before[chosen[1:]] == gone[:-1]] = r
        merged = np.full(len(chosen), r, dtype=np.int32)
        # the place beyond a word holds the token `size`, which no pair has on its left either
        falls = np.minimum(self.pair_ranks(left, merged), self.pair_ranks(merged, token[after[gone]])) < r
        if not falls.any():
            return chosen
        word = np.searchsorted(ends, chosen, side="right")
        earlier = np.cumsum(falls) - falls
        first = np.maximum.accumulate(np.where(np.append(True, word[1:] != word[:-1]), np.arange(len(chosen)), 0))
        return chosen[earlier == earlier[first]]


class BlockEncoder:
    """Texts to ids, a block at a time: `add` texts in UTF-8, then `flush` gives the ids of each of them."""

    def __init__(self, replay: Replay):
        self.replay = replay
        self._split = regex.compile(public_tokenizers.PATTERN).findall
        self._words: dict[bytes, bytes] = {}
        # chunks that follow a space, and those that do not
        self._known: tuple[dict[bytes, bytes], dict[bytes, bytes]] = {}, {}
        self._new: tuple[set[bytes], set[bytes]] = set(), set()
        self._pending: list[tuple[int, bytes]] = []
        self._ids: list[list[bytes]] = []
        self._new_bytes = self._known_bytes = self._word_bytes = 0

    def _chunks(self, text: bytes) -> tuple[list[bytes], list[bytes]]:
        """The chunks of a text after a space and the others before them; where spaces are no places to cut, all its
        words."""
        if _UNSAFE_ASCII.search(text) if text.isascii() else _UNSAFE.search(text.decode()):
            return [], self._matches(text)
        first, *rest = text.split(b" ")
        return rest, [first] if first else []

    def _matches(self, text: bytes) -> list[bytes]:
        return [w.encode() for w in self._split(text.decode())]

    def add(self, raw: bytes) -> None:
        if not raw.isascii():
            raw = raw.decode("utf-8", "replace").encode()
        at = len(self._ids)
        self._ids.append([])
        for piece in [raw] if len(raw) <= PIECE_CHARS else (p.encode() for p in pieces(raw.decode())):
            for chunks, known, new in zip(self._chunks(piece), self._known, self._new):
                fresh = set(chunks).difference(known, new)
                new |= fresh
                self._new_bytes += sum(map(len, fresh)) * 4 + len(fresh) * ENTRY_BYTES
            self._pending.append((at, piece))
            if self._new_bytes >= NEW_BYTES:
                self._encode_pending()

    def _learn(self) -> None:
        """Replay the merges over the words of all new chunks."""
        ids = self._words
        if self._word_bytes >= KNOWN_BYTES:
            ids.clear()
            self._word_bytes = 0
        several: dict[bytes, list[bytes]] = {}
        words: set[bytes] = set()
        for new, lead in zip(self._new, (b" ", b"")):
            for key in new:
                if key.isalpha():  # letters of ASCII alone are one word
                    words.add(lead + key)
                else:
                    several[lead + key] = found = self._matches(lead + key)
                    words.update(found)
        words.difference_update(ids)
        merged = []
        for word in words:
            rank = self.replay.ranks.get(word)
            if rank is None:
                merged.append(word)
            else:
                ids[word] = rank.to_bytes(4, "little")
        ids.update(zip(merged, self.replay.words(merged)))
        self._word_bytes += sum(map(len, words)) * 4 + len(words) * ENTRY_BYTES
        for known, new, lead in zip(self._known, self._new, (b" ", b"")):
            for key in new:
                found = several.get(lead + key)
                known[key] = ids[lead + key] if found is None else b"".join([ids[w] for w in found])
        self._known_bytes += self._new_bytes

    def _encode_pending(self) -> None:
        self._learn()
        after_space, plain = self._known
        for at, piece in self._pending:
            rest, first = self._chunks(piece)
            self._ids[at].append(b"".join([*map(plain.__getitem__, first), *map(after_space.__getitem__, rest)]))
        self._pending.clear()
        full = self._known_bytes >= KNOWN_BYTES
        for known, new in zip(self._known, self._new):
            if full:
                known.clear()
            new.clear()
        self._new_bytes = 0
        if full:
            self._known_bytes = 0

    def flush(self) -> list[np.ndarray]:
        self._encode_pending()
        done = [np.frombuffer(b"".join(parts), dtype="<i4") for parts in self._ids]
        self._ids = []
        return done


@functools.lru_cache(maxsize=2)
def replay(path: str) -> Replay:
    return Replay(path)


def encode_decode(
    docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """`keep` with ids (array of int), n_tokens and decoded (the bytes of those ids), of each whole text."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    added = T.StructType.fromDDL("ids array<int>, n_tokens long, decoded binary")
    schema = T.StructType([docs.schema[c] for c in keep] + added.fields)
    columns = [*keep, *([] if text in keep else [text])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, place, n = to_arrow_schema(schema), columns.index(text), len(keep)
        made = BlockEncoder(replay(path))
        block: list[pa.RecordBatch] = []
        held = 0

        def results():
            ids = iter(made.flush())
            for batch in block:
                own = [next(ids) for _ in range(batch.num_rows)]
                sizes = np.array([len(x) for x in own], dtype=np.int64)
                flat = np.concatenate(own) if own else np.zeros(0, dtype="<i4")
                offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())).cast(arrow.field(n).type)
                look = made.replay.token_bytes.__getitem__
                texts = pa.array([b"".join(map(look, x.tolist())) for x in own], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], lists, pa.array(sizes), texts], schema=arrow)
            block.clear()

        for batch in batches:
            for value in batch.column(place).cast(pa.binary()):
                made.add(value.as_py() or b"")
            block.append(batch)
            held += batch.nbytes
            if held >= BLOCK_BYTES:
                yield from results()
                held = 0
        yield from results()

    return docs.select(*columns).mapInArrow(run, schema)
