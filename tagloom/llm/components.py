"""Connected components of a graph given by its links, as repeated Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import stored
from tagloom.operators.joins import spread_join

#: Rounds after which the links must have settled; each round shortens the longest path by a factor.
MAX_ROUNDS = 100


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: every node sends its larger (or smaller) neighbours to its smallest neighbour.

    The smallest neighbour is found by an aggregate that merges in each task and is joined back, so a node with
    very many neighbours is never gathered in one place.
    """
    ends = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        ends = ends.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    sent = spread_join(ends, least, ["u"], "inner")
    if large:
        out = sent.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        others = sent.select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = others.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of a link; links have columns a and b.

    Large-star and small-star steps alternate until nothing changes. Links with a null end, and of a node to itself,
    are left out. Every round is written to the shared folder, so a lost executor costs no earlier round.
    """
    rows = links.where(F.col("a") != F.col("b"))
    now = rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = stored(now, "links"), None
    for _ in range(MAX_ROUNDS):
        digest = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if digest == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = digest
        now = stored(_star(_star(now, large=True), large=False), "links")
    raise RuntimeError(f"components have not settled in {MAX_ROUNDS} rounds")
