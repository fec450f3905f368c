"""Token-id files: ids one after the other, document boundaries as Elias-Fano sequences.

A file holds the ids of consecutive documents in ascending id order as 16-bit or 32-bit integers, and two
non-decreasing sequences: the document ends, and the document ids less the first one. Elias-Fano coding keeps the low
bits of each number as they are and the high bits in unary, about two bits a number; sampled select positions find the
i-th number without a table of 64-bit offsets.

Null and empty texts have only the end id. Documents without id come first, as in an ascending sort, and have no
number in the file; equal ids keep the order of their texts. An empty table gives no file.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm.common import Generations, new_folder, stored

MAGIC = b"EFIDS001"
#: Ids after which a task starts another file: files, and what a reader holds, stay bounded however large the input.
FILE_IDS = 4 << 20
END_ID = 0
#: One select position is kept for so many numbers.
SAMPLE = 256
_HEADER = struct.Struct("<8sQQQqQBB")
_SEQUENCE = struct.Struct("<QQB")


# --- Elias-Fano sequences ------------------------------------------------------


def elias_fano(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of non-negative numbers."""
    n = len(values)
    values = values.astype(np.uint64)
    top = int(values[-1]) if n else 0
    low_bits = max(0, (top // max(1, n)).bit_length() - 1)
    bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
    low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    high = np.zeros((int(ones[-1]) + 8) // 8 if n else 0, dtype=np.uint8)
    np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
    samples = ones[::SAMPLE].astype("<u4").tobytes()
    return _SEQUENCE.pack(n, len(high), low_bits) + low + high.tobytes() + samples


class EliasFano:
    """Reads a sequence from bytes; `size` is the number of bytes it takes."""

    def __init__(self, data: memoryview):
        self.n, high, self.low_bits = _SEQUENCE.unpack_from(data)
        low = (self.n * self.low_bits + 7) // 8
        at = _SEQUENCE.size
        self._low, self._high = np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, high, at + low)
        count = -(-self.n // SAMPLE)
        self._samples = np.frombuffer(data, "<u4", count, at + low + high)
        self.size = at + low + high + 4 * count

    def _select(self, i: int) -> int:
        """The position of the i-th one among the high bits, from the sample before it."""
        position, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte = position >> 3
        bits = int(self._high[byte]) >> (position & 7)
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            position, bits = byte << 3, int(self._high[byte])
        while left or not bits & 1:
            left -= bits & 1
            bits >>= 1
            position += 1
        return position

    def __getitem__(self, i: int) -> int:
        start = i * self.low_bits
        first, last = start >> 3, (start + self.low_bits + 7) >> 3
        low = int.from_bytes(self._low[first:last].tobytes(), "little") >> (start & 7)
        return (self._select(i) - i) << self.low_bits | low & ((1 << self.low_bits) - 1)

    def values(self) -> Iterator[int]:
        """The numbers one after the other, as `self[i]` gives them: selected at every sample, then the next one bit."""
        high, low, bits, mask = self._high, self._low, self.low_bits, (1 << self.low_bits) - 1
        for start in range(0, self.n, SAMPLE):
            stop = min(start + SAMPLE, self.n)
            position = int(self._samples[start // SAMPLE])
            first = start * bits >> 3
            lows = int.from_bytes(low[first : (stop * bits + 7) >> 3].tobytes(), "little") >> (start * bits & 7)
            end = int(self._samples[start // SAMPLE + 1]) if stop < self.n else 8 * len(high) - 1
            ones = int.from_bytes(high[position >> 3 : (end >> 3) + 1].tobytes(), "little") >> (position & 7)
            for i in range(start, stop):
                skip = (ones & -ones).bit_length() - 1
                position += skip
                yield (position - i) << bits | lows & mask
                ones >>= skip + 1
                lows >>= bits
                position += 1

    def all(self) -> np.ndarray:
        """The whole sequence, unpacked at once."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        values = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self._low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return (values + bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))).astype(np.int64)


# --- files ----------------------------------------------------------------------


def file_bytes(doc_ids: list[int | None], chunks: list[bytes], width: int) -> bytes:
    """A file of documents in order, each given as its ids of `width` bytes."""
    ends = np.cumsum([len(c) // width for c in chunks], dtype=np.int64)
    named = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    first = int(named[0]) if len(named) else 0
    offsets = named.astype(np.uint64) - np.uint64(first & (1 << 64) - 1)  # differences fit 64 unsigned bits
    ef_ends, ef_ids = elias_fano(ends), elias_fano(offsets)
    header = _HEADER.pack(MAGIC, len(doc_ids), int(ends[-1]) if len(ends) else 0, len(doc_ids) - len(named), first, len(ef_ends), width, 0)
    return b"".join([header, ef_ends, ef_ids, *chunks])


class IdFile:
    """Random access to the documents of a file."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, self.n_docs, self.n_ids, self.unnamed, self.first, ends, width, _ = _HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        self._ends = EliasFano(view[_HEADER.size :])
        self._ids = EliasFano(view[_HEADER.size + ends :])
        at = _HEADER.size + ends + self._ids.size
        self._data = np.frombuffer(view, f"<u{width}", self.n_ids, at)

    def bounds(self, i: int) -> tuple[int, int]:
        """First and end position of document i."""
        return (self._ends[i - 1] if i else 0), self._ends[i]

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self._data[start:end]

    def doc_id(self, i: int) -> int | None:
        return None if i < self.unnamed else self.first + self._ids[i - self.unnamed]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, first position and ids of every document."""
        start, named = 0, self._ids.values()
        for i, end in enumerate(self._ends.values()):
            yield (None if i < self.unnamed else self.first + next(named)), start, self._data[start:end]
            start = end


# --- encoding -------------------------------------------------------------------

#: Chunks in one generation of what a worker remembers.
REMEMBERED = 170_000
#: Bytes of texts that are cut and encoded together.
BLOCK_BYTES = 8 << 20
#: Pieces in one generation of what a worker remembers; those of one block may come on top.
PIECES = 300_000
#: Pieces that go to the library in one call.
CALL_PIECES = 4096
#: A space with white space on both sides, or before the end: no place to cut by spaces alone.
_UNSAFE = re.compile(r"\s (?:\s|\Z)")


#: White space outside ASCII, which the byte kinds do not know.
_WIDE_SPACE = re.compile(r"[^\S\x00-\x7f]")
_UNKNOWN, _LETTER, _VISIBLE, _BREAK, _BLANK = range(5)


def _kinds() -> np.ndarray:
    """The kind of each byte; control characters and all parts of longer characters are unknown."""
    out = np.full(256, _UNKNOWN, dtype=np.uint8)
    out[0x21:0x7F] = _VISIBLE
    for first in b"Aa":
        out[first : first + 26] = _LETTER
    out[0x09:0x0E], out[0x20] = _BREAK, _BLANK
    return out


def _cuts() -> np.ndarray:
    """Whether a text is cut between the second and the third of three bytes, by their kinds.

    No match of the byte-level split pattern goes on from a letter to anything else, nor from a visible character to
    white space; and one break between two visible characters is a match of its own.
    """
    out = np.zeros((5, 5, 5), dtype=bool)
    out[:, _LETTER, _VISIBLE:] = True
    out[:, _VISIBLE, _BREAK:] = True
    out[_LETTER : _VISIBLE + 1, _BREAK, _LETTER : _VISIBLE + 1] = True
    return out.ravel()


_KINDS, _CUTS = _kinds(), _cuts()


def piece_bounds(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin, and the end of the last one. data: the bytes of the texts one after the other;
    starts: the first byte of each, and the end of the last. The pieces' tokens one after the other are those of the texts."""
    kinds = _KINDS[data]
    flags = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        flags[2:-1] = _CUTS[kinds[:-2] * np.uint8(25) + kinds[1:-1] * np.uint8(5) + kinds[2:]]
    if len(data) > 1:  # the second byte has but one before it
        flags[1] = _CUTS[kinds[0] * 5 + kinds[1]]
    flags[starts] = True
    return np.flatnonzero(flags).astype(np.int32)


class ChunkEncoder:
    """The library's ids of whole texts, put together from those of chunks that start at a space.

    The byte-level split pattern never joins a space to what precedes it, so a text cut before its spaces has the
    tokens of its chunks, but for runs of white space; texts with those go to the library whole, as do chunks with
    special tokens. The new chunks of a text are encoded together: as every token stands for so many bytes, the
    chunks' ids are found in the result by length.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocab.values(), default=0) < 1 << 16 else 4
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self._special_bytes = [s.encode() for s in special]
        self._sizes = np.zeros(max(vocab.values(), default=0) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self._sizes[i] = len(token)  # a character stands for a byte
        self._known = Generations(REMEMBERED)
        self._pieces = Generations(PIECES)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=f"<u{self.width}")

    def _learn(self, chunks: dict[str, None], first: str) -> bytes:
        """Remember the ids of chunks, each with the space before it; the ids of the text's first chunk."""
        known, old = self._known.young, self._known.old
        joint = []
        for chunk in chunks:
            if chunk in old:
                known[chunk] = old[chunk]
            elif not chunk or chunk[0].isspace() or chunk[-1].isspace():
                known[chunk] = self._ids(" " + chunk).tobytes()
            else:
                joint.append(chunk)
        text = " ".join([first, *joint])
        if self._special.search(text) or first[-1:].isspace():
            known.update((chunk, self._ids(" " + chunk).tobytes()) for chunk in joint)
            return self._ids(first).tobytes()
        ids = self._ids(text)
        sizes = map(len, (first, *joint)) if text.isascii() else (len(c.encode()) for c in (first, *joint))
        # where each chunk ends in bytes, the spaces before all but the first counted
        ends = np.cumsum(np.fromiter(sizes, dtype=np.int64, count=len(joint) + 1) + 1) - 1
        cuts = (self.width * np.searchsorted(np.cumsum(self._sizes[ids]), ends, side="right")).tolist()
        packed, start = ids.tobytes(), cuts[0]
        for chunk, end in zip(joint, cuts[1:]):
            known[chunk] = packed[start:end]
            start = end
        return packed[: cuts[0]]

    def encode(self, text: str) -> bytes:
        if _UNSAFE.search(text):
            return self._ids(text).tobytes()
        first, *rest = text.split(" ")
        known = self._known.turned()
        parts = list(map(known.get, rest))
        head = self._learn(dict.fromkeys([c for c, part in zip(rest, parts) if part is None]), first)
        ids = b"".join([head, *map(known.__getitem__, rest)])
        self._known.forget_long()
        return ids

    def _cuttable(self, raw: bytes) -> bytes | None:
        """The text as UTF-8 that may be cut to pieces; none if it has special tokens or white space outside ASCII."""
        if not raw.isascii():
            text = raw.decode("utf-8", "replace")
            if _WIDE_SPACE.search(text):
                return None
            raw = text.encode()
        return None if any(s in raw for s in self._special_bytes) else raw

    def encode_all(self, raws: list[bytes]) -> list[bytes]:
        """The ids of several texts, as `encode` gives them: every distinct piece of theirs is looked up once."""
        texts = [self._cuttable(raw) for raw in raws]
        joined = b"".join([t for t in texts if t])
        starts = np.cumsum(np.array([0, *(len(t or b"") for t in texts)], dtype=np.int64))
        bounds = piece_bounds(np.frombuffer(joined, np.uint8), starts)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(joined)]
        coded = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers).dictionary_encode()
        _, places, letters = coded.dictionary.buffers()
        letters, ends = letters.to_pybytes(), np.frombuffer(places, np.int32, len(coded.dictionary) + 1).tolist()
        pieces = [letters[a:b] for a, b in zip(ends, ends[1:])]
        known = self._pieces.turned()
        parts = list(map(known.get, pieces))
        if None in parts:
            self._learn_pieces([piece for piece, part in zip(pieces, parts) if part is None])
            parts = list(map(known.__getitem__, pieces))
        self._pieces.forget_long()
        which, cuts = coded.indices.to_numpy(), np.searchsorted(bounds, starts).tolist()
        return [
            self.encode(raw.decode("utf-8", "replace")) if text is None else b"".join(map(parts.__getitem__, which[a:b].tolist()))
            for raw, text, a, b in zip(raws, texts, cuts, cuts[1:])
        ]

    def _learn_pieces(self, pieces: list[bytes]) -> None:
        """Remember the ids of pieces. Those of a space and a word, ASCII at both ends, are encoded one after the other
        in one text, as the split pattern parts them before each space."""
        known, old = self._pieces.young, self._pieces.old
        alone, joint = [], []
        for piece in pieces:
            if piece in old:
                known[piece] = old[piece]
            elif piece[0] == 32 and len(piece) > 1 and 32 < piece[1] < 127 and 32 < piece[-1] < 127:
                joint.append(piece)
            else:
                alone.append(piece)
        for at in range(0, len(joint), CALL_PIECES):
            some = joint[at : at + CALL_PIECES]
            text = b"".join(some)
            if any(s in text for s in self._special_bytes):
                alone += some
                continue
            ids = self._ids(text.decode())
            ends = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)))
            cuts = (self.width * np.searchsorted(np.cumsum(self._sizes[ids]), ends, side="right")).tolist()
            packed = ids.tobytes()
            known.update((piece, packed[a:b]) for piece, a, b in zip(some, [0, *cuts], cuts))
        for at in range(0, len(alone), CALL_PIECES):
            some = alone[at : at + CALL_PIECES]
            found = self.library.encode_batch_fast([piece.decode() for piece in some], add_special_tokens=False)
            known.update((piece, np.array(e.ids, dtype=f"<u{self.width}").tobytes()) for piece, e in zip(some, found))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


# --- Spark ----------------------------------------------------------------------


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Keys and texts in their order, as many at once as hold BLOCK_BYTES; null texts are empty."""
    ids: list[int | None] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(key)
            texts.append(value.as_py() or b"")
            held += len(texts[-1])
            if held >= BLOCK_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


_MANIFEST = "partition int, number int, path string, n_docs long, n_ids long"


def write_ids(
    docs: DataFrame, folder: str, path: str | None = None, key: str = "doc_id", text: str = "text",
    end_id: int = END_ID, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every text, write the files into `folder` and return their manifest, one row for each file.

    Spark sorts by id over range partitions; a task writes its files one after the other. A file takes its final name
    only when it is complete, and a retried task writes the same bytes, so lost executors leave no wrong file.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches):
        system, root = pa.fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        partition, number = TaskContext.get().partitionId(), 0
        made = encoder(path)
        end = end_id.to_bytes(made.width, "little")
        doc_ids: list[int | None] = []
        chunks: list[bytes] = []
        held = 0

        def flush():
            nonlocal number, held
            name = f"{root}/{partition:06d}-{number:06d}.efids"
            data = file_bytes(doc_ids, chunks, made.width)
            draft = f"{root}/.{uuid.uuid4().hex}"
            with system.open_output_stream(draft) as out:
                out.write(data)
            if system.get_file_info(name).type != pa.fs.FileType.NotFound:
                system.delete_file(name)
            system.move(draft, name)
            row = [partition, number, name, len(doc_ids), held]
            number, held = number + 1, 0
            doc_ids.clear()
            chunks.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["partition", "number", "path", "n_docs", "n_ids"],
            )

        for ids, texts in _blocks(batches):
            for doc_id, chunk in zip(ids, made.encode_all(texts)):
                doc_ids.append(doc_id)
                chunks.append(chunk + end)
                held += len(chunks[-1]) // made.width
                if held >= file_ids:
                    yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", "text")
    return stored(rows.select("key", F.col("text").cast("binary")).mapInArrow(run, _MANIFEST), "manifest")


def starts(manifest: DataFrame) -> DataFrame:
    """The manifest with base, the ids of all files before each; summed by partition first, then inside each."""
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("partition").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    totals = manifest.groupBy("partition").agg(F.sum("n_ids").alias("_ids"))
    totals = totals.select("partition", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    own = F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return manifest.withColumn("_own", own).join(totals, "partition").withColumn("base", F.col("_own") + F.col("_before")).drop("_own", "_before")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary, little-endian unsigned 32-bit integers) from the files."""

    def run(batches):
        system, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(path) as source:
                    file = IdFile(source.read())
                rows: list[tuple] = []
                held = 0
                for doc_id, start, ids in file.documents():
                    rows.append((doc_id, base + start, len(ids), ids.astype("<u4").tobytes()))
                    held += len(ids)
                    if held > 1 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    # one file is work enough for a task; a given number keeps Spark from merging these few rows
    spread = max(manifest.sparkSession.sparkContext.defaultParallelism, manifest.count() // 4)
    files = starts(manifest).select("path", "base").repartition(spread, "path")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["doc_id", "start", "n_tokens", "ids"]
    )


def crc32_of_ids(ids: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all documents to a new folder of the shared one and read them back."""
    folder = new_folder(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, folder, path, key, text), folder)
