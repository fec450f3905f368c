"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows, one scan of each text.

Words are the runs of a-z, 0-9 and non-ASCII characters after A-Z is lower-cased. A window is 10 consecutive words
of an item, or all of a shorter item's words. Every document word inside an occurrence of a window is hit.

Null and empty texts have no words: as items they have no window, as documents no hit. An item without id still
marks its words but is not counted as an item. Repeated items count once; repeated documents give a row each.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from itertools import accumulate

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import LOWER, per_text, stored

WINDOW = 10
#: Characters of windows, and of the item ids that go with them, in one automaton, which takes some 45 bytes for each.
#: A larger benchmark is scanned for in several passes.
SHARD_CHARS = 2 << 20

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_NORMAL = bytes(LOWER[b] if b not in _SEPARATORS else 32 for b in range(256))
_FOUND = ["n_words", "ranges", "items", "spans"]
_FIELDS = (
    "n_words long, ranges array<struct<first:long,stop:long>>, items array<string>, spans array<struct<start:long,stop:long>>"
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(raw: bytes) -> list[bytes]:
    """The normalised words of a text, as UTF-8."""
    return raw.translate(_NORMAL).split()


def windows(raw: bytes, size: int = WINDOW) -> list[bytes]:
    """The distinct windows of an item, each between single spaces."""
    found = words(raw)
    spans = (found[i : i + size] for i in range(max(1, len(found) - size + 1)) if found)
    return list(dict.fromkeys(b" %b " % b" ".join(span) for span in spans))


def benchmark_windows(
    benchmark: DataFrame, size: int = WINDOW, item: str = "item_id", text: str = "text"
) -> DataFrame:
    """One row for each distinct window: window (binary), items (array of ids as strings)."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    rows = per_text(rows, lambda: lambda raw: (windows(raw, size),), "windows array<binary>", ("item",))
    rows = rows.select("item", F.explode("windows").alias("window")).distinct()
    return rows.groupBy("window").agg(F.collect_set("item").alias("items"))


_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def _automaton(key: str, rows: list[tuple[bytes, list[str]]]) -> ahocorasick.Automaton:
    """The automaton of these windows, built once in a worker. Keys are UTF-8 read as Latin-1, a character a byte."""
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        made = ahocorasick.Automaton()
        for window, items in rows:
            made.add_word(window.decode("latin-1"), (len(window), window.count(b" ") - 1, items))
        made.make_automaton()
        _AUTOMATA[key] = made
    return _AUTOMATA[key]


def _find(automaton: ahocorasick.Automaton, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Ranges of hit words (first, end) and the items whose windows occur."""
    text = b" %b " % b" ".join(found)
    ranges, items, starts = [], set(), None
    for end, (length, n, of) in automaton.iter(text.decode("latin-1")):
        if starts is None:
            starts = list(accumulate((len(w) + 1 for w in found), initial=0))
        first = bisect_left(starts, end - length + 1)
        ranges.append((first, first + n))
        items.update(of)
    return ranges, items


def _marked(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges, in order."""
    out: list[list[int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def _original(raw: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code point offsets of the text as it was."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(raw.decode("utf-8", "replace"))]
    return [(at[first][0], at[end - 1][1]) for first, end in ranges]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    item: str = "item_id",
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """`keep` with n_words, n_hit, items (sorted ids, as strings) and spans (start, end in the original text).

    The windows and their item ids are broadcast in shards of about `shard_chars` characters (measured, not assumed):
    one shard, one scan. With more, each pass scans for one shard and its findings are written before the next.
    """
    spark = docs.sparkSession
    known = stored(benchmark_windows(benchmark, window, item), "windows")
    of_items = F.aggregate("items", F.lit(0).cast("long"), lambda n, name: n + F.octet_length(name) + 8)
    chars = known.agg(F.sum(F.length("window") + of_items)).first()[0] or 0
    shards = -(-chars // shard_chars) or 1
    source = text if text in keep else "_scanned"
    rows = docs.select(*keep, *([] if text in keep else [F.col(text).alias(source)]))
    for shard in range(shards):
        part = known.where(F.pmod(F.xxhash64("window"), F.lit(shards)) == shard)
        sent = spark.sparkContext.broadcast([(bytes(r.window), list(r["items"])) for r in part.collect()])

        def factory(sent=sent, key=uuid.uuid4().hex):
            automaton = _automaton(key, sent.value)

            def scan(raw: bytes, _n=0, ranges=(), items=(), _spans=()) -> tuple:
                have = words(raw)
                more, of = _find(automaton, have) if len(automaton) else ([], set())
                marked = _marked([*((r["first"], r["stop"]) for r in ranges), *more])
                return len(have), marked, sorted({*items, *of}), _original(raw, marked)

            return scan

        before = _FOUND if shard else []
        last = shard == shards - 1
        held = keep if last or text in keep else (*keep, source)
        rows = per_text(rows, factory, _FIELDS, held, source, before)
        rows = rows if last else stored(rows, "scanned")
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r.stop - r.first)
    return rows.select(*keep, "n_words", hit.alias("n_hit"), "items", "spans")
