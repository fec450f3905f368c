"""LM scoring: a gated recurrent language model trained and applied as Spark jobs, beside an add-0.1 unigram base.

Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end for each text. All training documents are
counted. The most frequent words form the model's vocabulary; every other word belongs to an outside class by its
shape, inside which words share out the class's probability by their smoothed counts, with room for one unseen word,
so that every text has a probability.

Training: each task learns by truncated backpropagation from every token of its training documents, the state carried
through each whole document, starting from the shared weights; the weights of all tasks are averaged, weighted by
tokens, in groups of bounded size; rounds follow on disjoint shares of the documents. Scoring carries the state through
each whole document too.

Null and empty texts consist of the end alone. A null id counts as an empty one, and so is held out. Repeated rows
each count and each get a row. Without training documents all counts are zero and scores come from the start weights.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagloom.llm.common import LOWER, stored
from tagloom.llm.gru import Gru
from tagloom.operators.joins import spread_join

VOCABULARY = 2048
#: Units of the recurrent state, and of a word's embedding.
STATE = 24
#: Most frequent words whose counts are broadcast; the counts of all others are joined.
HEAD = 200_000
HEAD_WORD_BYTES = 64
END = b""
ROUNDS = 2
#: Bytes of distinct words, with their share of the table, that a counting task holds before it passes its counts on.
HELD_BYTES = 32 << 20
#: What a distinct word takes beside its own bytes: object, entry of the table, count.
WORD_COST = 160
#: Bytes of a text that are cut into words at once; a word longer than this is one piece.
PIECE_BYTES = 1 << 20
#: Bytes of texts whose words are cut and looked up together.
BLOCK_BYTES = 4 << 20
#: Tokens that a scoring task handles at once.
HELD_TOKENS = 3 << 20
#: Weight vectors that are averaged in one group.
AVERAGED = 16

_MARKS = b".,!?;:'\")|*#$%&"
_ENDINGS = {b: k for k, letters in enumerate((b"e", b"s", b"n", b"ao", b"rl", b"td", b"iuy")) for b in letters}
#: Kind of the last byte: full stop and the like, other punctuation, anything else.
_KIND = [1 if b in b".!?;:" else 0 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)]
#: 8 endings of ASCII words and 7 groups of other words, by 3 kinds of punctuation.
SHAPES = 45


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(LOWER).split()


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Words:
    """The words of several texts: `which[starts[i]:starts[i + 1]]` are the numbers of those of text i in `distinct`."""

    def __init__(self, raws: list[bytes]):
        # a space after each text, so that no word goes on into the next
        data = np.frombuffer(b" ".join([*raws, b""]).translate(LOWER), np.uint8)
        inside = (data != 32) & (data - np.uint8(9) > 4)  # bytes below 9 go round to large ones
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[:1].any():
            turns = np.concatenate([[0], turns])
        heads, tails = turns[::2], turns[1::2]
        bounds = np.zeros(len(heads) + 1, dtype=np.int32)
        np.cumsum(tails - heads, out=bounds[1:])
        letters = data[inside]
        coded = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
        coded = coded.dictionary_encode()
        _, places, chars = coded.dictionary.buffers()
        self.which = coded.indices.to_numpy()
        ends = np.frombuffer(places, np.int32, len(coded.dictionary) + 1).tolist() if len(coded.dictionary) else [0]
        chars = chars.to_pybytes() if len(coded.dictionary) else b""
        self.distinct = [chars[a:b] for a, b in zip(ends, ends[1:])]
        at = np.cumsum([0, *(len(raw) + 1 for raw in raws)])
        self.starts = np.searchsorted(heads, at).tolist()


def blocks_of(texts: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """Texts in their order, as many at once as hold `size` bytes."""
    block: list[bytes] = []
    held = 0
    for raw in texts:
        block.append(raw)
        held += len(raw)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def pieces(raw: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in runs of about `size` bytes that end at white space, so that no word is cut."""
    at = 0
    while len(raw) - at > size:
        space = _SPACE.search(raw, at + size)
        if space is None:
            break
        yield raw[at : space.end()]
        at = space.end()
    yield raw[at:] if at else raw


def shape(word: bytes) -> int:
    """The outside class of a word, by its letters and its last character."""
    if not word:
        return 2 * 15 + 7
    last = word[-1]
    kind = 15 * _KIND[last]
    if word.isascii():
        if kind:
            bare = word.rstrip(_MARKS)
            last = bare[-1] if bare else 0
        return kind + _ENDINGS.get(last, 7)
    other = len(word) - len(word.lstrip(_ASCII))
    return kind + 8 + sum(word[other : other + 2]) % 7


_ASCII = bytes(range(128))


def tally_words(texts: Iterable[bytes], held: int = HELD_BYTES) -> Iterator[tuple[list[bytes], list[int]]]:
    """Distinct tokens and their counts, passed on whenever about `held` bytes of them have come together; a token may
    come again."""
    tally: Counter = Counter()
    taken = 0
    for raw in texts:
        for piece in pieces(raw):
            before = len(tally)
            tally.update(words_of(piece))
            grown = len(tally) - before
            taken += grown * WORD_COST + sum(map(len, islice(reversed(tally), grown)))
            if taken > held:
                yield list(tally), list(tally.values())
                tally.clear()
                taken = 0
        tally[END] += 1
    if tally:
        yield list(tally), list(tally.values())


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (binary; empty: end), shape and count of every distinct token, merged in each task first."""

    def run(batches):
        texts = (value.as_py() or b"" for batch in batches for value in batch.column(0).cast(pa.binary()))
        for words, counts in tally_words(texts):
            made = [pa.array(words, pa.binary()), pa.array(counts, pa.int64())]
            del words, counts
            whole = pa.RecordBatch.from_arrays(made, names=["word", "n"])
            for at in range(0, whole.num_rows, 20_000):
                yield whole.slice(at, 20_000)

    def shaped(batches):
        for batch in batches:
            kinds = pa.array([shape(w) for w in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), kinds, batch.column(1)], names=["word", "shape", "n"])

    parts = docs.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return parts.mapInArrow(shaped, "word binary, shape int, n long")


class Vocabulary:
    """What a worker needs to turn texts into model ids and unigram terms; all of bounded size."""

    def __init__(self, head: list[tuple[bytes, int, int]], size: int, total: int, distinct: int, by_shape: dict):
        self.size = min(size, len(head))
        self.total, self.distinct = total, distinct
        self.index = {word: i for i, (word, _, _) in enumerate(head)}
        self.counts = np.array([n for _, _, n in head], dtype=np.int64)
        shapes = np.array([s for _, s, _ in head], dtype=np.int64)
        self.ids = np.where(np.arange(len(head)) < self.size, np.arange(len(head)), shapes + self.size)
        # tokens and distinct words of each shape, without those of the vocabulary
        inside = np.arange(len(head)) < self.size
        self.shape_tokens = np.array([by_shape.get(s, (0, 0))[0] for s in range(SHAPES)], dtype=np.int64)
        self.shape_words = np.array([by_shape.get(s, (0, 0))[1] for s in range(SHAPES)], dtype=np.int64)
        np.subtract.at(self.shape_tokens, shapes[inside], self.counts[inside])
        np.subtract.at(self.shape_words, shapes[inside], 1)
        self.shape_scale = -np.log10(self.shape_tokens + 0.1 * (self.shape_words + 1))
        self._shape_scale = self.shape_scale.tolist()
        self.base_scale = -np.log10(self.total + 0.1 * (self.distinct + 1))
        self.count_term = np.log10(self.counts + 0.1)
        # the log10 probability of a head word inside its outside class; nothing for the vocabulary
        self.inside_term = np.where(inside, 0.0, self.count_term + self.shape_scale[shapes])

    def model(self) -> Gru:
        return Gru(self.size, SHAPES, STATE).start(self.counts[: self.size], self.shape_tokens)

    def encode(self, raw: bytes) -> tuple:
        """n_tokens, n_known, base, inside, ids and rare: the parts of a text's scores that need no model, its model
        ids as 16-bit integers, and the words that are not in the head, repeats included."""
        sums, ids, rare, words = (0, 0, 0.0, 0.0), [], [], []
        for piece in pieces(raw):
            if words:
                sums = self._add(words, *sums, ids, rare)
            words = words_of(piece)
        words.append(END)
        n, known, base, inside = self._add(words, *sums, ids, rare)
        return n, known, base, inside, b"".join(ids), rare

    def encode_all(self, raws: list[bytes]) -> list[tuple]:
        """What `encode` gives for each text; every distinct word of theirs is looked up once."""
        short = [raw if len(raw) <= PIECE_BYTES else b"" for raw in raws]
        words = Words(short)
        places = np.fromiter(map(self.index.get, words.distinct, repeat(-1)), dtype=np.int64, count=len(words.distinct))
        shapes = {i: shape(words.distinct[i]) for i in np.flatnonzero(places < 0).tolist()}
        # the end stands for itself, after the distinct words
        end = len(places)
        places = np.append(places, self.index.get(END, -1))
        if places[end] < 0:
            shapes[end] = shape(END)
        words.distinct.append(END)
        codes = self.ids[places].astype("<u2") if len(self.ids) else np.empty(len(places), dtype="<u2")
        codes[list(shapes)] = [self.size + kind for kind in shapes.values()]
        # the tokens of all texts, and what is known of those in the head
        which = np.insert(words.which, words.starts[1:], end)
        starts = [start + i for i, start in enumerate(words.starts)]
        at, made = np.take(places, which), np.take(codes, which)
        inside_head = at >= 0
        found = at[inside_head]
        base, inside = np.take(self.count_term, found), np.take(self.inside_term, found)
        before = np.concatenate([[0], np.cumsum(inside_head)])[starts].tolist()
        others = which[~inside_head].tolist()
        out = []
        for raw, a, b, c, d in zip(raws, starts, starts[1:], before, before[1:]):
            if len(raw) > PIECE_BYTES:
                out.append(self.encode(raw))
                continue
            term, rare = float(inside[c:d].sum()), others[a - c : b - d]
            for i in rare:
                term += self._shape_scale[shapes[i]]
            total = (b - a) * self.base_scale + float(base[c:d].sum())
            out.append((b - a, d - c, total, term, made[a:b].tobytes(), [words.distinct[i] for i in rare]))
        return out

    def _add(self, words: list, n: int, known: int, base: float, inside: float, ids: list, rare: list) -> tuple:
        at = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        found = at[at >= 0]
        here = np.empty(len(at), dtype="<u2")
        here[at >= 0] = self.ids[found]
        base += len(at) * self.base_scale + float(self.count_term[found].sum())
        inside += float(self.inside_term[found].sum())
        for i in np.flatnonzero(at < 0).tolist():
            kind = shape(words[i])
            here[i] = self.size + kind
            inside += self._shape_scale[kind]
            rare.append(words[i])
        ids.append(here.tobytes())
        return n + len(at), known + len(found), base, inside


_HELD: dict[str, object] = {}


def _once(key: str, make):
    """A value that a worker makes once and keeps until it needs one of another key."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def read_vocabulary(counts: DataFrame, size: int = VOCABULARY, head: int = HEAD) -> Vocabulary:
    """At most `head` words of bounded length and one row for each shape reach the driver.

    Words are cut off at a count, found from the number of words in each eighth of a power of two.
    """
    level = F.floor(F.log2("n") * 8)
    short = counts.where(F.length("word") <= HEAD_WORD_BYTES).withColumn("level", level)
    least, words = None, 0
    for row in sorted(short.groupBy("level").count().collect(), key=lambda r: -r.level):
        words += row["count"]
        if words > head:
            break
        least = row.level
    top = short.where(F.col("level") >= least).collect() if least is not None else []
    top.sort(key=lambda r: (-r.n, bytes(r.word)))
    shapes = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    by_shape = {r["shape"]: (r["n"], r["words"]) for r in shapes}
    total, distinct = sum(n for n, _ in by_shape.values()), sum(w for _, w in by_shape.values())
    return Vocabulary([(bytes(r["word"]), r["shape"], r["n"]) for r in top], size, total, distinct, by_shape)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> DataFrame:
    """One stored row for each document, named by `row`, with what `Vocabulary.encode` gives."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    name = uuid.uuid4().hex

    added = T.StructType.fromDDL(
        "row long, n_tokens long, n_head long, base double, inside double, ids binary, rare array<binary>"
    )
    schema = T.StructType([docs.schema[key], docs.schema["held_out"], *added.fields])

    def run(batches):
        known: Vocabulary = _once(name, lambda: sent.value)
        arrow, row = to_arrow_schema(schema), TaskContext.get().partitionId() << 36
        for batch in batches:
            at = 0
            values = (value.as_py() or b"" for value in batch.column(2).cast(pa.binary()))
            for block in blocks_of(values, BLOCK_BYTES):
                columns = [*zip(*known.encode_all(block))]
                rows = range(row + 1, row + 1 + len(block))
                arrays = [pa.array(v, type=arrow.field(2 + k).type) for k, v in enumerate([rows, *columns])]
                kept = [batch.column(k).slice(at, len(block)) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], schema=arrow)
                at, row = at + len(block), row + len(block)

    return stored(docs.select(key, "held_out", text).mapInArrow(run, schema), "encoded")


def _average(parts: DataFrame) -> np.ndarray | None:
    """The weighted mean of the weight vectors, summed in groups of AVERAGED until one row is left."""

    def add(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["part"].to_pylist(), group["tokens"].to_pylist(), group["sums"].to_pylist()))
        total = np.sum([np.frombuffer(s, "<f8") for _, _, s in rows], axis=0)
        part = rows[0][0] // AVERAGED
        made = [[part], [sum(t for _, t, _ in rows)], [total.tobytes()]]
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.table({n: pa.array(v, k) for n, v, k in zip(("part", "tokens", "sums"), made, kinds)})

    while True:
        highest = parts.agg(F.max("part")).first()[0]
        if highest is None:
            return None
        if highest == 0 and parts.count() == 1:
            row = parts.first()
            return np.frombuffer(bytes(row.sums), "<f8") / row.tokens
        parts = parts.groupBy(F.floor(F.col("part") / AVERAGED)).applyInArrow(add, "part long, tokens long, sums binary")
        parts = stored(parts, "sums")


def train(encoded: DataFrame, model: Gru, end: int, rounds: int = ROUNDS) -> Gru:
    """The model after `rounds` rounds over disjoint shares of the training documents."""
    spark = encoded.sparkSession
    for turn in range(rounds):
        mine = encoded.where(~F.col("held_out") & (F.pmod(F.xxhash64("row"), F.lit(rounds)) == turn))
        sent = spark.sparkContext.broadcast((model.words, model.outside, model.size, model.vector))

        def run(batches, sent=sent):
            words, outside, size, vector = sent.value
            own = Gru(words, outside, size, vector.copy())
            values = (value.as_py() for batch in batches for value in batch.column(0))
            tokens = own.train((np.frombuffer(value, "<u2").astype(np.int32) for value in values), end)
            if tokens:
                sums = (own.vector.astype("<f8") * tokens).tobytes()
                made = [[TaskContext.get().partitionId()], [tokens], [sums]]
                kinds = (pa.int64(), pa.int64(), pa.binary())
                names = ["part", "tokens", "sums"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds)], names=names)

        parts = stored(mine.select("ids").mapInArrow(run, "part long, tokens long, sums binary"), "weights")
        vector = _average(parts)
        if vector is not None:
            model = Gru(model.words, model.outside, model.size, vector)
    return model


def model_scores(encoded: DataFrame, model: Gru, end: int) -> DataFrame:
    """row and model_score: log10 of the probability of each document's model ids."""
    sent = encoded.sparkSession.sparkContext.broadcast((model.words, model.outside, model.size, model.vector))

    def run(batches):
        own = Gru(*sent.value)
        rows: list[int] = []
        waiting: list[np.ndarray] = []

        def out():
            logs = own.score(waiting, end) / np.log(10)
            made = pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(logs)], names=["row", "model_score"])
            rows.clear()
            waiting.clear()
            return made

        held = 0
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.append(row)
                waiting.append(np.frombuffer(value.as_py(), "<u2").astype(np.int64))
                held += len(waiting[-1])
                if held > HELD_TOKENS:
                    yield out()
                    held = 0
        if rows:
            yield out()

    return encoded.select("row", "ids").mapInArrow(run, "row long, model_score double")


def rare_terms(encoded: DataFrame, counts: DataFrame) -> DataFrame:
    """row, rare_term (sum of log10(count + 0.1)) and rare_known of the words outside the head."""
    rare = encoded.select("row", F.explode("rare").alias("word"))
    joined = spread_join(rare, counts.select("word", "n"), ["word"], "left", spread_by=["row"])
    term = F.log10(F.coalesce("n", F.lit(0)) + 0.1)
    return joined.groupBy("row").agg(F.sum(term).alias("rare_term"), F.count("n").alias("rare_known"))


def score_documents(
    docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY,
    head: int = HEAD, rounds: int = ROUNDS,
) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; learnt from the rows for
    which `held_out` is false."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), held_out.alias("held_out"))
    counts = stored(count_words(rows.where(~F.col("held_out")), "_text"), "counts")
    known = read_vocabulary(counts, vocabulary, head)
    encoded = encode_documents(rows, known, "_key", "_text")
    end = int(known.ids[known.index[END]]) if END in known.index else known.size + shape(END)
    model = train(encoded, known.model(), end, rounds)
    scored = stored(model_scores(encoded, model, end), "scored")
    slim = encoded.select("_key", "held_out", "row", "n_tokens", "n_head", "base", "inside")
    out = slim.join(scored, "row").join(rare_terms(encoded, counts), "row", "left")
    rare = F.coalesce("rare_term", F.lit(0.0))
    return out.select(
        F.col("_key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + rare).alias("base_score"),
        (F.col("model_score") + F.col("inside") + rare).alias("score"),
    )
