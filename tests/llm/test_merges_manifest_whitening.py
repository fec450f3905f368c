"""Merge replay against the library, the manifest and the whitening against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest

from tagloom.llm import merge_replay, merkle, queries, whitening
from tagloom.llm.token_counts import encoding

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- merge replay ----------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return encoding(RANKS).encode_ordinary


def encode_all(texts):
    made = merge_replay.BlockEncoder(merge_replay.replay(RANKS))
    for text in texts:
        made.add(text.encode())
    return [x.tolist() for x in made.flush()]


def test_replay_equals_the_library_on_random_texts(library):
    rng = random.Random(5)
    parts = [*"aabbetthhe  \n\t'sSD019.,-éßΣ日本가\x1c\x85　😀²½", "th", "the", "ing", " the", "'ll", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(20_000)]
    texts += ["".join(rng.choice("th") for _ in range(rng.randrange(300))) for _ in range(500)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2000)) for _ in range(30)]
    texts += ["", "a" * 100_000, "th" * 20_000, "=" * 30_000, " " * 5_000, "日" * 3_000]
    assert encode_all(texts) == [library(t) for t in texts]


def test_replay_splits_code_points_as_the_library_does(library):
    texts = ["a" + c + "b1" + c + "2 " + c + " " + c + c for c in map(chr, range(0x20000)) if not "\ud800" <= c < ""]
    assert encode_all(texts) == [library(t) for t in texts]


def test_blocks_end_early_and_memory_is_emptied(library, monkeypatch):
    monkeypatch.setattr(merge_replay, "NEW_BYTES", 2_000)
    monkeypatch.setattr(merge_replay, "KNOWN_BYTES", 4_000)
    monkeypatch.setattr(merge_replay, "PIECE_CHARS", 100)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(900)}x" for _ in range(rng.randrange(200))) for _ in range(50)]
    made = merge_replay.BlockEncoder(merge_replay.replay(RANKS))
    for _ in range(2):
        for text in texts:
            made.add(text.encode())
        assert [x.tolist() for x in made.flush()] == [library(t) for t in texts]
        assert made._known_bytes < 4_000


def test_operator_keeps_rows_and_decodes_what_it_encoded(odd_docs, no_docs, library):
    keep = ("doc_id", "ids", "text")
    rows = merge_replay.encode_decode(odd_docs.drop("n_tokens").withColumnRenamed("ids", "other"), keep=("doc_id", "other", "text"))
    assert rows.columns == ["doc_id", "other", "text", "ids", "n_tokens", "decoded"]
    got = rows.collect()
    assert len(got) == odd_docs.count() and keep
    for r in got:
        assert list(r.ids) == library(r.text or "") and r.n_tokens == len(r.ids)
        assert bytes(r.decoded) == (r.text or "").encode()
    assert merge_replay.encode_decode(no_docs).count() == 0


def test_broken_utf8_is_read_as_replacement_characters(spark, library):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert list(merge_replay.encode_decode(docs).first().ids) == library("a�b")


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = []
    for d in docs:
        ids = library(d.text or "")
        texts = ",".join(map(str, ids)).encode(), (d.text or "").encode()
        want.append((d.doc_id, len(ids), *[hashlib.sha256(x).hexdigest() for x in texts]))
    assert sorted(map(tuple, queries.op11_merge_replay(spark, FOLDER).collect())) == sorted(want)


# --- manifest --------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """The root, and for each leaf its siblings before and after, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = place - place % 8
            paths[i].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 8])))
            at[i] = place // 8
        nodes = [sha(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_manifest(rows):
    """rows of (doc_id, source, lang, n_chars, text)"""

    def leaf(row):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def lowered(text):
        return text if text is None else text.encode().lower().decode()

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0], leaf(row), row))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    first = lambda r: (r[0] is not None, r[0] or 0, r[1])
    parts = {t: climb([h for _, h, _ in sorted(trees[t], key=first)]) for t in names}
    root, over = climb([parts[t][0] for t in names]) if names else (None, [])
    out = []
    for t, upper in zip(names, over):
        for (doc_id, h, row), path in zip(sorted(trees[t], key=first), parts[t][1]):
            cur = h
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                cur = leaf((*row[:4], lowered(row[4])))
            for before, after in (*path, *upper):
                cur = sha(before, cur, after)
            proof = sha(*(x for pair in (*path, *upper) for x in pair))
            out.append((doc_id, h, parts[t][0], root, proof, cur, cur == root))
    return out


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def check_manifest(docs, depth):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    got = merkle.manifest(merkle.document_leaves(docs), "lang", "doc_id", depth=depth).drop("lang")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=sort_key) == sorted(plain_manifest(rows), key=sort_key)


@pytest.mark.parametrize("levels", range(1, 6))
def test_addresses_are_a_layout_of_whole_subtrees(levels):
    places = [merkle.address(levels, d) for d in range(levels)]
    assert sorted(np.concatenate(places)) == list(range(merkle.size(levels)))
    upper = levels // 2
    if upper:  # every lower half is one stretch
        inside = merkle.size(levels - upper)
        low = [merkle.address(levels, d).reshape(8**upper, -1) for d in range(upper, levels)]
        for b in range(8**upper):
            stretch = np.concatenate([x[b] for x in low])
            assert stretch.max() - stretch.min() + 1 == inside == len(stretch)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 511, 512, 513, 4096])
def test_subtree_of_a_block(n):
    leaves = [hashlib.sha256(b"%d" % i).hexdigest() for i in range(n)]
    root, paths = climb(leaves)
    tree = merkle.Subtree([x.encode() for x in leaves], merkle.levels_of(n, 4))
    assert tree.root.decode() == root
    for i in {0, n // 2, n - 1}:
        path = tree.siblings(i)
        assert [(a.decode(), b.decode()) for a, b in path] == paths[i]
        assert merkle.fold(leaves[i].encode(), path).decode() == root
        assert merkle.fold(b"0" * 64, path).decode() != root or n == 1


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_manifest_of_uneven_groups(spark, depth):
    rng = random.Random(depth)
    langs = ["en"] * 40 + ["de", "fr", None, "", "+", "é", "日本", *[f"x{i}" for i in range(12)]]
    rows = [(i, rng.choice(["a", None]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "Abc É", "plain", "X" * 3000])) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    check_manifest(docs, depth)


def test_manifest_of_several_blocks(spark):
    docs = spark.range(9_001).selectExpr("id AS doc_id", "'s' AS source", "if(id % 1000 = 7, 'b', 'a') AS lang", "id AS n_chars", "concat('Text ', id) AS text")
    check_manifest(docs, merkle.DEPTH)


def test_manifest_of_awkward_rows(spark, odd_docs, no_docs, make):
    check_manifest(odd_docs, 1)
    check_manifest(no_docs, 4)
    check_manifest(make([(1, "one Row")]), 4)


# --- whitening ---------------------------------------------------------------------


def matrices():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    spectra = {
        "ties": [7.0] * 10 + [3] * 10 + [1] * 10,
        "graded": 10.0 ** -np.arange(30),
        "close": 1 + 1e-13 * np.arange(30),
        "outlier": [1e12] + [1] * 29,
        "singular": [5, 4, 3] + [0] * 27,
        "even": np.arange(30) + 1.0,
    }
    for name, values in spectra.items():
        yield name, (q * np.array(values, float)) @ q.T
    b = rng.normal(size=(300, 96))
    yield "random", b.T @ b
    yield "identity", np.eye(9)
    yield "zero", np.zeros((4, 4))
    yield "one", np.array([[3.0]])


@pytest.mark.parametrize("name,matrix", list(matrices()))
def test_components_equal_an_eigen_decomposition(name, matrix):
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.components(matrix)
    scale = max(1e-300, np.linalg.norm(matrix, 2))
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1]).max() <= 1e-14 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() <= 1e-14 * len(matrix)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-14 * scale


def test_polar_factor_is_a_sign():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    values = np.array([1e-9, -1e-9, *np.linspace(-3, 5, 18)])
    sign = (q * np.sign(values)) @ q.T
    assert np.abs(whitening.polar((q * values) @ q.T) - sign).max() < 1e-6


def plain_whitening(rows):
    good = [(k, v) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in good], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = np.array((n * x - s) / n, dtype=float)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    return {
        k: (int(((n * row - s) ** 2).sum()), w, values / np.trace(cov))
        for (k, _), row, w in zip(good, x, centred @ vectors / np.sqrt(values))
    }, n


def single(rows):
    """Entries as the table holds them, 32 bits wide."""
    cut = lambda x: x if x is None or not math.isfinite(x) else struct.unpack("f", struct.pack("f", x))[0]
    return [(k, v if v is None else [cut(x) for x in v]) for k, v in rows]


def check_whitening(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = whitening.whiten(frame).collect()
    want, n = plain_whitening(single(rows))
    assert {r.vec_id for r in got} == set(want)
    count = min(8, len(next(iter(want.values()))[1]))
    assert len(got) == len(want) * count
    signs = {}
    for r in got:
        deviation, w, share = want[r.vec_id]
        assert r.n == n and r.deviation == deviation and r.identity_error < 1e-8
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-8)
        value = w[r.component - 1]
        if abs(value) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(value) * np.sign(r.whitened))
        assert abs(r.whitened) == pytest.approx(abs(value), rel=1e-6, abs=1e-9)
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    scale = np.linspace(3, 0.2, 12)
    rows = [(i, (rng.normal(size=12) * scale).tolist()) for i in range(400)]
    odd = [(1000, None), (1001, [None] + [0.1] * 11), (1002, [float("nan")] + [0.1] * 11), (1003, [float("-inf")] + [0.1] * 11)]
    check_whitening(spark, rows + odd)


def test_whitening_of_few_dimensions_and_repeated_rows(spark):
    rng = np.random.default_rng(9)
    check_whitening(spark, [(i, rng.normal(size=3).tolist()) for i in range(50)])
    rows = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [0.0, 5.0]), (9, [4.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 8 and {r.n for r in got} == {4}


def test_whitening_without_variance_or_rows(spark):
    kind = "vec_id long, embedding array<float>, component int, n long"
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 1, 1)], [(1, [], 1, 1)], [(1, [1.0, 2.0], 1, 1)], [(1, [1.0, 2.0], 1, 1), (2, [1.0, 2.0], 1, 1)]):
        out = whitening.whiten(spark.createDataFrame(rows, kind))
        assert out.columns == columns and out.count() == 0


def test_whitening_of_extreme_entries(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(30)]
    kind = "vec_id long, embedding array<float>"
    # too large for 64 bits once scaled, and of another length: no part
    more = [(100, [1e30, 0.0]), (101, [1.0, 2.0, 3.0])]
    base, same = (whitening.whiten(spark.createDataFrame(r, kind)).collect() for r in (rows, rows + more))
    assert {r.vec_id for r in same} == set(range(30))
    assert sorted((r.vec_id, r.component, r.deviation) for r in base) == sorted((r.vec_id, r.component, r.deviation) for r in same)
    # within 64 bits, but not its deviation
    far = whitening.whiten(spark.createDataFrame(rows + [(102, [1e15, 0.0])], kind)).collect()
    assert {r.deviation for r in far if r.vec_id == 102} == {None}
    assert all(abs(r.identity_error) < 1e-4 for r in far)


def test_whitening_query_has_every_row(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got = queries.op13_embedding_whitening(spark, FOLDER)
    assert got.count() == 8 * table.count()
    assert got.agg({"identity_error": "max"}).first()[0] < 1e-8
