"""Token counts, word BPE and token-id files against the tokenizer libraries."""

from __future__ import annotations

import base64
import random
import sys
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers_llm import awkward, key
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagloom.llm import id_files, token_counts, word_bpe

BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
WORD = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
BPE = word_bpe.tokenizer(public_tokenizers.path("word_bpe_49k.json"))


# --- counts ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def lengths():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return np.array([len(plain.encode_ordinary(t or "")) for _, t in awkward()])


def test_histogram_and_suffix_sums(odd_docs, lengths):
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(odd_docs)), width=7)
    rows = {r.n_tokens: r for r in sums.collect()}
    assert set(rows) == set(lengths.tolist())
    for n, r in rows.items():
        assert (r.docs, r.tokens) == ((lengths == n).sum(), lengths[lengths == n].sum())
        assert (r.docs_at_least, r.tokens_at_least) == ((lengths >= n).sum(), lengths[lengths >= n].sum())
        assert (r.total_truncated, r.total_tokens) == (np.minimum(lengths, n).sum(), lengths.sum())
        assert r.quantile == pytest.approx((lengths <= n).mean())


def test_every_limit_and_quantile(odd_docs, lengths):
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(odd_docs))).cache()
    limits = [0, 1, 2, 5, 17, 18, 1000, 10**6]
    got = {r.context_limit: r for r in token_counts.at_limits(sums, limits).collect()}
    for n in limits:
        assert (got[n].docs_cut, got[n].total_truncated) == ((lengths > n).sum(), np.minimum(lengths, n).sum())
    shares = [0.01, 0.5, 0.9, 1.0]
    for r in token_counts.quantile_lengths(sums, shares).collect():
        assert r.n_tokens == np.sort(lengths)[int(np.ceil(r.share * len(lengths))) - 1]


def test_counts_of_nothing(no_docs):
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(no_docs)))
    assert sums.collect() == []
    assert [(r.docs_cut, r.total_truncated) for r in token_counts.at_limits(sums, [5]).collect()] == [(0, 0)]


@given(st.text(alphabet="ab .\n\t é", max_size=60))
@settings(max_examples=200, deadline=None)
def test_pieces_have_the_texts_tokens(text):
    encode = token_counts.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode_ordinary
    cut = list(token_counts.pieces(text, 5))
    assert "".join(cut) == text
    assert [i for piece in cut for i in encode(piece)] == encode(text)


# --- word BPE -------------------------------------------------------------------


def test_awkward_texts_encode_and_decode_as_the_library(odd_docs):
    got = word_bpe.encode_decode(odd_docs).collect()
    want = []
    for doc_id, text in awkward():
        ids = WORD.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, np.array(ids, "<u4").tobytes(), len(ids), WORD.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_no_documents_no_ids(no_docs):
    assert word_bpe.encode_decode(no_docs).collect() == []


@given(st.text(max_size=40))
@settings(max_examples=400, deadline=None)
def test_any_text_encodes_as_the_library(text):
    text = "".join(c for c in text if unicodedata.category(c) != "Cn")
    assert BPE.encode(text) == WORD.encode(text, add_special_tokens=False).ids


@given(st.text(alphabet="aàbcdeéfHIJ .,!?'0123#$\n\t <|>endoftxsar", max_size=80))
@settings(max_examples=300, deadline=None)
def test_chunks_join_to_the_text(text):
    ids = [i for chunk in text.encode().split() for i in BPE.chunk(chunk.decode())]
    assert ids == WORD.encode(text, add_special_tokens=False).ids


def test_long_words_give_what_short_ones_give():
    rng = random.Random(5)
    for size in (3, 50, 199, 400):
        parts = [BPE.inner[rng.choice(b"theandingoution")] for _ in range(size)]
        scanned, heaped = BPE.merge(parts[:200]), BPE._merge_long(parts[:200])
        assert scanned == heaped
    word = "".join(rng.choice("abcdefgh") for _ in range(5000))
    assert BPE.encode(word) == WORD.encode(word, add_special_tokens=False).ids


# --- Elias-Fano and files ---------------------------------------------------------


@given(st.lists(st.integers(0, 1 << 40), max_size=700).map(sorted))
@settings(max_examples=100, deadline=None)
def test_elias_fano_gives_back_every_number(values):
    data = id_files.elias_fano(np.array(values, dtype=np.uint64))
    read = id_files.EliasFano(memoryview(data + b"rest"))
    assert read.size == len(data)
    assert read.all().tolist() == values
    assert [read[i] for i in range(len(values))] == values


@given(st.lists(st.integers(0, 2**62), max_size=600), st.integers(0, 40))
@settings(max_examples=80, deadline=None)
def test_elias_fano_is_read_in_order_through_select(values, shift):
    numbers = sorted(v >> shift for v in values)
    made = id_files.EliasFano(memoryview(id_files.elias_fano(np.array(numbers, dtype=np.uint64))))
    assert list(made.values()) == numbers


def test_files_are_read_without_unpacking_whole_sequences(monkeypatch):
    chunks = [np.arange(i % 7, dtype="<u2").tobytes() for i in range(2000)]
    data = id_files.file_bytes([None, None, *range(5, 3 * 1998 + 5, 3)], chunks, 2)
    monkeypatch.setattr(id_files.EliasFano, "all", lambda self: 1 / 0)
    got = list(id_files.IdFile(data).documents())
    assert [d for d, _, _ in got] == [None, None, *range(5, 3 * 1998 + 5, 3)]
    assert [start for _, start, _ in got] == [sum(j % 7 for j in range(i)) for i in range(2000)]
    assert all(ids.tobytes() == chunk for (_, _, ids), chunk in zip(got, chunks))


def test_long_words_are_not_remembered():
    """Encoders of megabyte words stay small, and right."""
    rng = random.Random(4)
    texts = [" ".join(["short", "".join(rng.choice("abcdef0") for _ in range(20_000)), f"w{i % 3}"]) for i in range(60)]
    words = word_bpe._encoder(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made = id_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts:
        assert words(text.encode()) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        made.encode(text)
    for memory in (made._known, word_bpe._chunks(public_tokenizers.path("word_bpe_49k.json"))):
        assert max(map(len, memory.young)) <= 256 and len(memory.young) >= 3


def test_elias_fano_is_near_the_bound():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 30, 100_000))
    bits = 8 * len(id_files.elias_fano(values)) / len(values)
    assert bits < 2 + np.log2((1 << 30) / 100_000) + 0.3  # and not 64


def test_file_of_documents():
    chunks = [np.array(c, "<u2").tobytes() for c in ([1, 2, 0], [0], [9, 0], [7, 7, 7, 0])]
    file = id_files.IdFile(id_files.file_bytes([None, -3, 4, 4], chunks, 2))
    assert [file.doc_id(i) for i in range(4)] == [None, -3, 4, 4]
    assert [file.document(i).tolist() for i in range(4)] == [[1, 2, 0], [0], [9, 0], [7, 7, 7, 0]]
    assert [(d, s, ids.tolist()) for d, s, ids in file.documents()][2] == (4, 4, [9, 0])


@given(st.text(alphabet="ab .,\n\t éZ1<|endoftx>", max_size=60))
@settings(max_examples=300, deadline=None)
def test_chunks_encode_as_the_library(text):
    made = id_files.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(made.encode(text), "<u2").tolist() == BYTE.encode(text, add_special_tokens=False).ids


@given(st.lists(st.text(alphabet="abZ1 .,'(\n\t\r éÉ日²\u0301\u00a0\u2003\x85\x1c\x00", max_size=30), max_size=12))
@settings(max_examples=300, deadline=None)
def test_texts_of_a_block_encode_as_the_library(texts):
    made = id_files.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    got = made.encode_all([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [BYTE.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_tokens_and_bad_bytes_in_a_block():
    made = id_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [b"a <|endoftext|> b", b"", b"x\xff y", b"<|endof", b"text|> 'll don't", "a\u3000 b".encode()]
    want = [BYTE.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(g, "<u2").tolist() for g in made.encode_all(texts)] == want
    assert made.encode_all([]) == []


def test_a_word_is_encoded_once_whatever_stands_beside_it():
    """The library gets each word of many texts once, not once for each mark or line end after it."""
    made = id_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(8)
    words = ["".join(rng.choice("aeiourstn") for _ in range(9)) for _ in range(100)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", ".", ",", ";\n" + rng.choice(words)]) for _ in range(200)) for _ in range(60)]

    class Counting:
        library, letters = made.library, 0

        def encode_batch_fast(self, texts, **options):
            self.letters += sum(map(len, texts))
            return self.library.encode_batch_fast(texts, **options)

    made.library = counting = Counting()
    for at in range(0, 60, 20):
        made.encode_all([t.encode() for t in texts[at : at + 20]])
    assert counting.letters < 2 * 100 * 10 + 20  # after a space, and at the start of a line


def test_pieces_are_remembered_within_bounds(monkeypatch):
    monkeypatch.setattr(id_files, "PIECES", 50)
    made = id_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for i in range(30):
        text = " ".join(f"w{j}x" for j in range(20 * i, 20 * i + 40)) + " " + "y" * 300
        assert np.frombuffer(made.encode_all([text.encode()])[0], "<u2").tolist() == BYTE.encode(text, add_special_tokens=False).ids
        assert len(made._pieces.young) + len(made._pieces.old) < 4 * 50 + 100
        assert max(map(len, made._pieces.young)) <= 256


def test_round_trip_in_ascending_order(odd_docs, spark, tmp_path):
    folder = f"file://{tmp_path}/ids"
    manifest = id_files.write_ids(odd_docs, folder, file_ids=50)
    got = id_files.read_ids(manifest, folder).collect()
    assert manifest.count() > 5 and len(list((tmp_path / "ids").glob("*.efids"))) == manifest.count()
    rows = sorted(got, key=lambda r: r.start)
    texts = awkward()
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [d for d, _ in order]
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    want = sorted((d, (np.array(BYTE.encode(t or "", add_special_tokens=False).ids + [0], "<u4")).tobytes()) for d, t in texts if d is not None)
    assert sorted((r.doc_id, bytes(r.ids)) for r in rows if r.doc_id is not None) == want
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in id_files.crc32_of_ids(id_files.read_ids(manifest, folder)).collect()}
    assert all(crc[r.doc_id, r.start] == zlib.crc32(bytes(r.ids)) for r in rows)


def test_no_documents_no_files(no_docs):
    assert id_files.round_trip(no_docs).collect() == []


def test_every_assigned_letter_is_cut_as_the_library_cuts():
    letters = [chr(c) for c in range(sys.maxunicode) if unicodedata.category(chr(c))[0] in "LNMSPZ" and c % 7 == 0]
    for at in range(0, len(letters), 500):
        text = " a".join(letters[at : at + 500])
        assert BPE.encode(text) == WORD.encode(text, add_special_tokens=False).ids, at
