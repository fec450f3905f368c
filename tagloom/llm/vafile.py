"""Exact top-k search by inner product with a vector-approximation file.

Vectors become integers (floor of `scale` times each component). A cell of 8 bits for each dimension approximates
them. Cells are cut at quantiles and, from the middle outwards, at growing distances, so that neither crowded values nor
outliers of whatever size share a wide cell; the least and greatest value in a cell bound it. A scan of the cells alone
bounds every score from both sides; the (k+1)th largest lower bound of a query rules out most vectors. Exact vectors are
then read in bound order: first the k+1 with the highest upper bounds, then those whose upper bound still reaches the
worst exact score found, so that the k-th result is certain.

Equal vectors are searched for as one, with their k+1 smallest ids, so no number of copies makes more candidates.
Queries meet the cells in blocks of at most QUERY_BLOCK, one block after the other: the only data broadcast besides the
cell bounds.

Rows with null id, and vectors that are null or hold a null or non-finite component, or one that 64 bits cannot hold as
an integer, take no part. Equal rows count once; an id with several vectors is a query with each and never its own
result. Vectors of different lengths are not compared. Ties go to the smaller id. Pairs whose score does not fit 64 bits
are no results.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import stored
from tagloom.operators.joins import spread_join

SCALE = 1024
LEVELS = 256
QUERY_BLOCK = 4096
#: Rows of cells and queries that are multiplied at once.
_ROWS = 1024
_RESULT = "query_id long, rank int, vec_id long, score long"


def _fits(x: Column, scale: int) -> Column:
    """Finite, and within 64 bits once scaled; a NaN is greater than all numbers."""
    return F.coalesce(F.abs(x.cast("double") * scale) < F.lit(2.0**63 - 1024), F.lit(False))


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """id and v (array of long) of the rows that take part, equal rows once."""
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: _fits(x, scale)))
    # Spark may look at a vector before it drops it
    whole = F.transform(vector, lambda x: F.when(_fits(x, scale), F.floor(x.cast("double") * scale)))
    return rows.select(F.col(key).cast("long").alias("id"), whole.alias("v")).distinct()


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """rep (smallest id), v and ids (the k+1 smallest ids, ascending) of each distinct vector."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    first = rows.withColumn("_n", place).where(F.col("_n") <= k + 1)
    return first.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))


class Grid(NamedTuple):
    """The cells of each dimension: the edges between them, dim x (LEVELS - 1), and the middle and half width of the
    values in each, dim x LEVELS."""

    edges: np.ndarray
    middle: np.ndarray
    half: np.ndarray


#: Edges beyond the middle half on each side: the first half of them at even distances, the others at growing ones.
_OUTER = 40
#: Edges of equal width inside the bulk; what is left are quantiles.
_EVEN = 80


def edges_of(exact: DataFrame, dim: int) -> np.ndarray:
    """The edges: quantiles, even ones across the bulk, and outer ones up to the ends of 64 bits.

    Quantiles are approximate; the bounds of the cells, taken afterwards, are not.
    """
    inner = LEVELS - 1 - 2 * _OUTER - _EVEN
    shares = [i / (inner + 1) for i in range(1, inner + 1)]
    quantiles = [F.percentile_approx(F.col("v")[i], shares, 2000).alias(f"d{i}") for i in range(dim)]
    found = exact.agg(F.count("*"), *quantiles).first()
    edges = np.zeros((dim, LEVELS - 1))
    for i in range(dim):
        cuts = np.array(found[f"d{i}"], dtype=float)
        spread = max(1.0, cuts[3 * inner // 4] - cuts[inner // 4])
        near = np.linspace(1, 4, _OUTER // 2)
        far = 4 * 2.0 ** np.linspace(0, max(1.0, 61 - np.log2(spread)), _OUTER // 2 + 1)[1:]
        out = spread * np.concatenate([near, far])
        middle = cuts[inner // 2]
        edges[i] = np.sort(np.concatenate([cuts, np.linspace(cuts[0], cuts[-1], _EVEN), middle - out, middle + out]))
    return edges


def grid(exact: DataFrame, dim: int) -> Grid:
    """The cells for all vectors; at most dim x LEVELS pairs of numbers reach the driver."""
    edges = edges_of(exact, dim)

    def run(batches):
        low, high = np.full((dim, LEVELS), np.inf), np.full((dim, LEVELS), -np.inf)
        for batch in batches:
            values = _matrix(batch.column(0), dim).astype(float)
            for d in range(dim):
                cells = np.searchsorted(edges[d], values[:, d], side="right")
                np.minimum.at(low[d], cells, values[:, d])
                np.maximum.at(high[d], cells, values[:, d])
        at = np.nonzero(low <= high)
        kinds = (at[0], pa.int32()), (at[1], pa.int32()), (low[at], pa.float64()), (high[at], pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in kinds], names=["d", "cell", "low", "high"])

    seen = exact.select("v").mapInArrow(run, "d int, cell int, low double, high double")
    middle, half = np.zeros((dim, LEVELS)), np.zeros((dim, LEVELS))
    for r in seen.groupBy("d", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        middle[r.d, r.cell], half[r.d, r.cell] = (r.low + r.high) / 2, (r.high - r.low) / 2
    return Grid(edges, middle, half)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def approximate(exact: DataFrame, cells: Grid) -> DataFrame:
    """The approximation file: rep and cells, one byte for each dimension."""
    dim, edges = len(cells.edges), cells.edges

    def run(batches):
        for batch in batches:
            values = _matrix(batch.column(1), dim).astype(float)
            codes = np.empty(values.shape, np.uint8)
            for d in range(dim):
                codes[:, d] = np.searchsorted(edges[d], values[:, d], side="right")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in codes], pa.binary())], names=["rep", "cells"]
            )

    return exact.select("rep", "v").mapInArrow(run, "rep long, cells binary")


def _bounds(codes: np.ndarray, cells: Grid, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of cell middles with queries, and the radius within which each exact score lies."""
    d = np.arange(codes.shape[1])
    middle, half = cells.middle[d, codes], cells.half[d, codes]
    radius = half @ np.abs(q).T
    # no sum of products is larger than this
    largest = np.linalg.norm(np.abs(middle) + half, axis=1)[:, None] * np.linalg.norm(q, axis=1)
    # the second term covers rounding of sums of this size, and of the cells themselves
    return middle @ q.T, radius * (1 + 1e-9) + largest * 1e-12 + 1e-6


def scan(cells: DataFrame, bounds: Grid, queries: list[tuple[int, list[int]]], k: int) -> DataFrame:
    """query, rep, least and most: the bounds of all pairs that a task's own lower bounds do not rule out. Written, and
    what was broadcast is taken back, before this returns."""
    dim, n = len(bounds.edges), k + 1
    sent = cells.sparkSession.sparkContext.broadcast(
        (bounds, np.array([q for q, _ in queries]), np.array([v for _, v in queries], dtype=float).reshape(len(queries), dim))
    )

    def run(batches):
        table, names, q = sent.value
        top = np.full((n, len(names)), -np.inf)  # the greatest lower bounds so far
        kept: list[tuple] = []

        def trimmed():
            at, rep, least, most = (np.concatenate(x) for x in zip(*kept)) if kept else (np.empty(0, int),) * 4
            good = most >= top[0][at] if len(at) else np.empty(0, bool)
            return at[good], rep[good], least[good], most[good]

        held = 0
        for batch in batches:
            reps = batch.column(0).to_numpy(zero_copy_only=False)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(reps), dim)
            for start in range(0, len(reps), _ROWS):
                some = slice(start, start + _ROWS)
                for block in range(0, len(names), _ROWS):
                    part = slice(block, block + _ROWS)
                    centre, near = _bounds(codes[some], table, q[part])
                    least, most = centre - near, centre + near
                    both = np.concatenate([top[:, part], least])
                    top[:, part] = np.sort(np.partition(both, len(both) - n, axis=0)[-n:], axis=0)
                    row, col = np.nonzero(most >= top[0, part])
                    kept.append((col + block, reps[some][row], least[row, col], most[row, col]))
                    held += len(row)
                    if held > 2_000_000:
                        kept[:] = [trimmed()]
                        held = len(kept[0][0])
        at, rep, least, most = trimmed()
        for start in range(0, len(at), 100_000):
            s = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[at[s]], pa.int64()), pa.array(rep[s], pa.int64()), pa.array(least[s]), pa.array(most[s])],
                names=["query", "rep", "least", "most"],
            )

    found = stored(cells.mapInArrow(run, "query long, rep long, least double, most double"), "bounds")
    sent.destroy()
    return found


_HALF, _WIDE = 1 << 32, "decimal(38,0)"


def _halves(a: Column) -> tuple[Column, Column]:
    """a mod 2^32 and a div 2^32 of a whole number, exact."""
    a, low = a.cast(_WIDE), F.pmod(a.cast(_WIDE), F.lit(_HALF).cast(_WIDE))
    return low, ((a - low) / F.lit(_HALF).cast("decimal(19,0)")).cast(_WIDE)


def _added(part: Callable[[Column], Column]) -> Column:
    """The sum of part(qv[i]) * v[i]."""
    products = F.zip_with("qv", "v", lambda a, b: part(a).cast("decimal(19,0)") * b.cast("decimal(19,0)"))
    return F.aggregate(products, F.lit(0).cast(_WIDE), lambda s, x: (s + x).cast(_WIDE))


def _scored(pairs: DataFrame, exact: DataFrame, queries: DataFrame, small: bool) -> DataFrame:
    """query, rep and the exact score, of the pairs whose score fits a long; `small` vectors give no other."""
    if small:
        product = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    else:
        # a * b as (a div 2^32) * b * 2^32 + (a mod 2^32) * b: the sum of either part stays within 38 digits
        low, high = _added(lambda a: _halves(a)[0]), _added(lambda a: _halves(a)[1])
        rest = F.pmod(low, F.lit(_HALF).cast(_WIDE))
        whole = (high + _halves(low)[1]).cast(_WIDE)
        inside = (whole >= -(1 << 31)) & (whole < 1 << 31)
        product = F.when(inside, whole.cast("long") * _HALF + rest.cast("long"))
    rows = pairs.join(exact.select("rep", "v"), "rep").join(queries.select(F.col("rep").alias("query"), F.col("v").alias("qv")), "query")
    return rows.select("query", "rep", product.alias("score")).where(F.col("score").isNotNull())


def _first(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first `n` rows of each query: each task cuts its own before the shuffle."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def _refined(bounds: DataFrame, exact: DataFrame, queries: DataFrame, k: int, small: bool) -> DataFrame:
    """The exact k+1 best distinct vectors of each query: query, rep, score."""
    bar = _first(bounds, k + 1, F.col("least").desc()).groupBy("query").agg(F.min("least").alias("_bar"), F.count("*").alias("_n"))
    left = spread_join(bounds, bar, ["query"], "inner", spread_by=["rep"])
    left = stored(left.where((F.col("_n") <= k) | (F.col("most") >= F.col("_bar"))).drop("_bar", "_n"), "survivors")
    top = stored(_first(left, k + 1, F.col("most").desc(), F.col("rep")), "top")
    first = stored(_scored(top, exact, queries, small), "first")
    sure = first.groupBy("query").agg(F.min("score").alias("_sure"), F.count("*").alias("_n"))
    # those behind the last of the first in bound order
    last = top.groupBy("query").agg(F.min(F.struct("most", (-F.col("rep")).alias("_rep"))).alias("_last"))
    known = last.join(sure, "query", "left")
    rest = spread_join(left, known, ["query"], "inner", spread_by=["rep"])
    behind = F.struct(F.col("most"), (-F.col("rep")).alias("_rep")) < F.col("_last")
    # a first one whose score does not fit is no result, so another may come in for it
    reaches = (F.coalesce("_n", F.lit(0)) <= k) | (F.col("most") >= F.col("_sure"))
    rest = rest.where(behind & reaches).select("query", "rep")
    rows = first.unionByName(_scored(rest, exact, queries, small))
    return _first(rows, k + 1, F.col("score").desc(), F.col("rep"))


def _search(exact: DataFrame, asked: DataFrame, dim: int, k: int) -> DataFrame:
    """query_id, rank, vec_id and score for vectors of one length."""
    bounds = grid(exact, dim)
    cells = stored(approximate(exact, bounds), "cells")
    # whether no score at all can pass 64 bits
    small = float(((np.abs(bounds.middle) + bounds.half).max(axis=1) ** 2).sum()) < 2.0**62
    queries = stored(asked.select("rep", "v").distinct(), "queries")
    blocks = -(-queries.count() // QUERY_BLOCK)
    parts = []
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("rep"), F.lit(blocks)) == block)
        parts.append(scan(cells, bounds, [(r.rep, r.v) for r in mine.collect()], k))
    pairs = functools.reduce(DataFrame.unionByName, parts)
    best = _refined(pairs, exact, queries, k, small).join(exact.select("rep", "ids"), "rep")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    ids = best.select("query", "score", F.explode("ids").alias("id")).withColumn("_n", F.row_number().over(order))
    hits = ids.where(F.col("_n") <= k + 1).groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score"))).alias("hits"))
    named = spread_join(asked.select("id", "rep"), hits.withColumnRenamed("query", "rep"), ["rep"], "inner", spread_by=["id"])
    others = F.slice(F.filter("hits", lambda h: h.id != F.col("id")), 1, k)
    out = named.select(F.col("id").alias("query_id"), F.posexplode(others).alias("_at", "hit"))
    return out.select("query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k best of all other rows for every row where `is_query`
    (an expression over `id`) holds."""
    rows = stored(integer_vectors(vectors, key, vector, scale), "rows")
    found = []
    for (dim,) in rows.select(F.size("v")).distinct().collect():
        same = rows.where(F.size("v") == dim)
        exact = stored(distinct_vectors(same, k), "exact")
        asked = spread_join(same.where(is_query), exact.select("v", "rep"), ["v"], "inner", spread_by=["id"])
        asked = stored(asked, "asked")
        if not asked.isEmpty():
            found.append(_search(exact, asked, dim, k))
    if not found:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    return functools.reduce(DataFrame.unionByName, found)
