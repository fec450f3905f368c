"""Merkle manifest of a dataset: a tree of runs of eight for each group of rows, and a tree over the groups.

Rows become leaves by a range sort and a running number, so a group of any size is dealt to blocks of 4,096
consecutive leaves, each an aligned subtree of four levels that one task builds. Block roots are the leaves of the next round of
blocks, until every group has one root left: a round
leaves one row in 4,096, so a few rounds serve any table. Proofs go
the other way: each round hands every block the siblings above its root, and a block adds those inside it.

Inside a block the digests lie in van Emde Boas order: a subtree of h levels is its upper half, then each of its lower
halves, each stored in the same way. `address` computes places, for building and for finding siblings alike, so that a
path from leaf to root touches few stretches of memory whatever the size of a cache line.

Null values are leaves' contents like others; groups are ordered with null first, then by UTF-8 bytes; leaves by key with
null first, equal keys by their digests, so that repeated rows have one defined order. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import stored

#: Consecutive nodes that become one.
FAN = 8
#: Levels of edges in a block: 4,096 leaves.
DEPTH = 4


def digest(parts: Sequence[bytes]) -> bytes:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def size(levels: int) -> int:
    """Nodes of a whole tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


@functools.lru_cache(maxsize=None)
def address(levels: int, depth: int) -> np.ndarray:
    """The places of the nodes at `depth`, left to right, of a tree of `levels` levels in van Emde Boas order."""
    if levels == 1:
        return np.zeros(1, dtype=np.int64)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth)
    inside = address(levels - upper, depth - upper)
    starts = size(upper) + size(levels - upper) * np.arange(FAN**upper)
    return (starts[:, None] + inside).ravel()


class Subtree:
    """The nodes over the leaves of a block; `levels` edges from leaf to root."""

    def __init__(self, leaves: Sequence[bytes], levels: int):
        self.levels, self.counts = levels, [len(leaves)]
        self.nodes = np.zeros(size(levels + 1), dtype="S64")
        self.nodes[address(levels + 1, levels)[: len(leaves)]] = leaves
        for depth in range(levels - 1, -1, -1):
            below, here = address(levels + 1, depth + 1), address(levels + 1, depth)
            n = self.counts[-1]
            children = self.nodes[below[:n]].tolist()
            runs = [digest(children[i : i + FAN]) for i in range(0, n, FAN)]
            self.nodes[here[: len(runs)]] = runs
            self.counts.append(len(runs))

    @property
    def root(self) -> bytes:
        return self.nodes[address(self.levels + 1, 0)[0]].item()

    def siblings(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """From leaf to root, the digests before and after the node in its run, each joined."""
        path = []
        for up in range(self.levels):
            first = leaf - leaf % FAN
            places = address(self.levels + 1, self.levels - up)[first : min(first + FAN, self.counts[up])]
            run = self.nodes[places].tolist()
            at = leaf - first
            path.append((b"".join(run[:at]), b"".join(run[at + 1 :])))
            leaf //= FAN
        return path


def levels_of(n: int, depth: int) -> int:
    """Edges between a leaf of a block and the block's root, where the group has `n` nodes in this round."""
    levels = 0
    while n > 1 and levels < depth:
        n, levels = -(-n // FAN), levels + 1
    return levels


def fold(leaf: bytes, path: Sequence[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        leaf = digest((before, leaf, after))
    return leaf


# --- Spark ----------------------------------------------------------------------


def field_text(column: str | Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    return F.sha2(F.concat(*[field_text(c) for c in columns]), 256)


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """`rows` with `_at`, the place of a row in its tree from 0 by `order`, and `_n`, the rows of the tree.

    Rows are sorted over range partitions, numbered in each task and written; the counts of each task, one row for a
    tree in a partition, give what comes before.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            local = []
            for name in batch.column(0).to_pylist():
                if name != last:
                    last, count = name, 0
                local.append(count)
                count += 1
            added = [pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "_part", "_local"])

    columns = [tree, *[c for c in rows.columns if c != tree]]
    ordered = rows.select(*columns).repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    schema = T.StructType([*ordered.schema.fields, *T.StructType.fromDDL("_part int, _local long").fields])
    done = stored(ordered.mapInArrow(number, schema), "numbered")
    counts = done.groupBy(tree, "_part").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        tree,
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(tree)).alias("_n"),
    )
    found = done.join(placed, [tree, "_part"])
    return found.select(*columns, (F.col("_before") + F.col("_local")).alias("_at"), "_n")


def _blocks(nodes: DataFrame, depth: int, *more: str):
    """`nodes` by the block that they lie in."""
    block = F.floor(F.col("_at") / FAN**depth).cast("long").alias("_block")
    return nodes.select("tree", "digest", "_at", "_n", *more, block).groupBy("tree", "_block")


def _subtree(block: pa.Table, depth: int) -> tuple[Subtree, pa.Table]:
    """The subtree of a block's rows, and the rows by place."""
    rows = block.sort_by("_at")
    leaves = [x.hex().encode() for x in rows.column("digest").to_pylist()]
    return Subtree(leaves, levels_of(rows.column("_n")[0].as_py(), depth)), rows


def block_roots(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One node for each block of `nodes` (tree, digest as bytes, _at, _n): those of the next round."""

    def root(block: pa.Table) -> pa.Table:
        n = block.column("_n")[0].as_py()
        made = {
            "tree": block.column("tree")[:1],
            "digest": pa.array([bytes.fromhex(_subtree(block, depth)[0].root.decode())], pa.binary()),
            "_at": block.column("_block")[:1],
            "_n": pa.array([-(-n // FAN**depth)], pa.int64()),
        }
        return pa.table(made)

    return _blocks(nodes, depth).applyInArrow(root, "tree string, digest binary, _at long, _n long")


def rounds(nodes: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """`nodes`, and the block roots of each round until every tree has one; each round is written."""
    found = [nodes]
    most = nodes.agg(F.max("_n")).first()[0] or 0
    while most > 1:
        found.append(stored(block_roots(found[-1], depth), "roots"))
        most = -(-most // FAN**depth)
    return found


_PATH = "array<struct<before:string,after:string>>"
_ARROW_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _given(upper: pa.Table) -> list[tuple[bytes, bytes]]:
    """The path above a block, which comes with it in one row."""
    return [(p["before"].encode(), p["after"].encode()) for p in upper.column("path")[0].as_py()]


def paths(nodes: DataFrame, above: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(tree, _at, path) of all `nodes`, given the paths `above` of their block roots."""

    def add(block: pa.Table, upper: pa.Table) -> pa.Table:
        subtree, rows = _subtree(block, depth)
        rest = _given(upper)
        whole = [[{"before": a, "after": b} for a, b in (*subtree.siblings(i), *rest)] for i in range(len(rows))]
        return pa.table({"tree": rows.column("tree"), "_at": rows.column("_at"), "path": pa.array(whole, _ARROW_PATH)})

    heads = above.select("tree", F.col("_at").alias("_block"), "path").groupBy("tree", "_block")
    return _blocks(nodes, depth).cogroup(heads).applyInArrow(add, f"tree string, _at long, path {_PATH}")


def _down(found: list[DataFrame], top: DataFrame, depth: int) -> DataFrame:
    """From the paths `top` of the last round's single nodes to those of the first round's block roots."""
    for nodes in reversed(found[1:-1]):
        top = paths(nodes, top, depth)
    return top


def manifest(
    leaves: DataFrame, tree: str, key: str, leaf: str = "leaf", tampered: str = "tampered", depth: int = DEPTH
) -> DataFrame:
    """The columns of `leaves` but `tampered`, with subroot, root, proof_sha256, folded_root and verified.

    `leaves` has a row for each leaf with its digest in hex; a tree holds the rows of one value of `tree`, by `key`. A
    digest in the column `tampered` is folded with the leaf's siblings in the leaf's place. `verified` says whether the
    fold gives the root. `depth` is the number of levels in a block, of no influence on the result.
    """
    rest = [c for c in leaves.columns if c not in (leaf, tampered)]
    # a group's name: null before all others, which keep their order by bytes
    named = leaves.select(
        F.coalesce(F.concat(F.lit("+"), F.col(tree).cast("string")), F.lit("")).alias("tree"),
        F.struct(*rest).alias("row"),
        F.unhex(leaf).alias("digest"),
        F.unhex(tampered).alias("_tampered"),
    )
    # written first: the range sort reads its input twice
    named = stored(named, "digests").withColumn("_key", F.col("row")[key])
    placed = stored(numbered(named, "tree", ["_key", "digest", "_tampered"]).drop("_key"), "leaves")
    found = rounds(placed, depth)
    subroots = stored(found[-1].select("tree", "digest"), "subroots")

    # the groups' own tree, the only one of its kind
    groups = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    groups = stored(numbered(groups, "tree", ["name"]), "groups")
    over = rounds(groups, depth)
    top = over[-1].select("tree", "_at", F.array().cast(_PATH).alias("path"))
    group_paths = paths(groups, _down(over, top, depth), depth).join(groups, ["tree", "_at"]).select(F.col("name").alias("tree"), "path")
    tops = subroots.join(group_paths, "tree").select(
        "tree",
        F.lit(0).cast("long").alias("_at"),
        "path",
        F.lower(F.hex("digest")).alias("subroot"),
        F.lower(F.hex(over[-1].select("digest").scalar())).alias("root"),
    )
    tops = stored(tops, "tops")
    above = _down(found, tops, depth).select("tree", "_at", "path").join(tops.select("tree", "subroot", "root"), "tree")

    def prove(block: pa.Table, upper: pa.Table) -> pa.Table:
        subtree, rows = _subtree(block, depth)
        rest, n = _given(upper), len(rows)
        last_parts = b"".join(part for pair in rest for part in pair)
        subroot, top = upper.column("subroot")[0].as_py(), upper.column("root")[0].as_py()
        proofs, folded = [], []
        for i, (own, changed) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("digest", "_tampered")))):
            path = subtree.siblings(i)
            proofs.append(digest([*(part for pair in path for part in pair), last_parts]).decode())
            folded.append(fold((own if changed is None else changed).hex().encode(), [*path, *rest]).decode())
        made = {
            "row": rows.column("row"),
            "digest": rows.column("digest"),
            "subroot": pa.array([subroot] * n, pa.string()),
            "root": pa.array([top] * n, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([f == top for f in folded], pa.bool_()),
        }
        return pa.table(made)

    heads = above.withColumnRenamed("_at", "_block").groupBy("tree", "_block")
    added = "subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    row_type = placed.schema["row"].dataType.simpleString()
    proved = _blocks(placed, depth, "row", "_tampered").cogroup(heads).applyInArrow(prove, f"row {row_type}, digest binary, {added}")
    kept = [F.lower(F.hex("digest")).alias(c) if c == leaf else F.col("row")[c].alias(c) for c in leaves.columns if c != tampered]
    return proved.select(*kept, *T.StructType.fromDDL(added).names)


#: A-Z and a-z, for `translate`.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def document_leaves(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """doc_id, lang, the leaf of each document, and the one it has once tampered with: where 3 divides the CRC-32 of the
    decimal id, A-Z of the text in lower case. Other rows, and those without id, are not tampered with: null."""
    lower = [F.translate("text", _UPPER, _LOWER) if c == "text" else c for c in fields]
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return docs.select("doc_id", "lang", leaf_digest(fields).alias("leaf"), F.when(hit, leaf_digest(lower)).alias("tampered"))
