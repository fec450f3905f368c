"""Equi-join of a large frame to a lookup that stays balanced when a key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 4096

_SLOT = "_slot"

#: A key is hot from this share of the rows.
HOT_SHARE = 1 / 64


def find_hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list[str]:
    """Values of a text column that are on `share` of the rows or more, most frequent first; null is none of them.

    A frequent-items sketch, merged from all tasks: it reads the column once and is never off by more than a thousandth
    of the rows, so no key above the share by that much is missed. At most 1 / share values reach the driver.
    """
    if not 0.002 <= share <= 1:
        raise ValueError("a share between 0.002 and 1")
    most = int(1 / share) + 1
    found = df.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).agg(
        F.expr(f"approx_top_k(_key, {most}, 10000)").alias("top"), F.count("*").alias("rows")
    )
    row = found.first()
    return [] if not row.rows else [t.item for t in row.top if t["count"] >= share * row.rows]


def hot_hashes(counted: DataFrame, keys: Sequence[Column | str], share: float = HOT_SHARE) -> Column:
    """Hashes of the keys that are on `share` of the rows of `counted` or more, as an array.

    A scalar subquery of the same query, so nothing is read while the plan is built; the sketch is that of `find_hot_keys`.
    Rows with a null key are none of them. Two keys of one hash are both taken as hot, which does no harm.
    """
    most = int(1 / share) + 1
    rows = counted.select(*[(F.col(k) if isinstance(k, str) else k).alias(f"_{i}") for i, k in enumerate(keys)]).dropna()
    found = rows.select(F.xxhash64(*rows.columns).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {most}, 10000)").alias("top"), F.count("*").alias("rows")
    )
    often = F.filter("top", lambda t: t["count"] >= share * F.col("rows"))
    return found.select(F.transform(often, lambda t: t["item"]).alias("hot")).scalar()


def colocated_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], by: str, how: str = "left") -> DataFrame:
    """The same join for two sides that lie in equal buckets of the key `by`: no side moves.

    Spark keeps the buckets only where the bucket column is the one key of the join, so the other keys are compared as
    a range of one value. A hot value of `by` lies in one bucket and stays there; where one is to be expected, use
    tables without buckets and `spread_join`.
    """
    if by not in keys:
        raise ValueError(f"{by} is not a key of the join")
    other = {k: f"_right_{k}" for k in keys}
    right = lookup.withColumnsRenamed(other)
    same = F.col(by) == F.col(other[by])
    for k in keys:
        if k != by:
            same = same & (F.col(k) >= F.col(other[k])) & (F.col(k) <= F.col(other[k]))
    return facts.join(right, same, how).drop(*other.values())


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot_keys: Sequence[str] = (),
    spread_by: Sequence[str] | None = None,
    slots: int = SLOTS,
    counted: DataFrame | None = None,
    counted_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join `facts` to `lookup` on `keys`, with the same result as a plain join.

    Three things keep one task from getting a hot key:

    * rows with a null key match nothing; they go to a slot by a hash of the row
      instead of all to the same task;
    * keys known to be hot (`hot_keys`, values of the first key column, see `find_hot_keys`)
      are salted: their rows are split over `slots`, and only their few lookup rows are repeated;
    * so are keys that the query itself finds to be hot, if it gets `counted`, a frame with the columns `counted_by`
      (the keys, or those of them that make a key hot) of about the same frequencies as `facts` and cheap to read.
      Adaptive execution alone leaves a hot key whole up to its threshold, and a key that holds most rows leaves so many
      partitions empty that it does not broadcast a short lookup either;
    * the slot makes Spark shuffle both sides for this join alone, also where the
      lookup comes out of an aggregate on the same key.  So both sides are plain
      shuffles, which is what adaptive execution needs to split any other hot key.

    The slot is a function of the row, so a recomputed task gives the same rows.
    Where the lookup is under Spark's broadcast threshold, Spark broadcasts it.
    """
    if spread_by is None:
        spread_by = [
            f.name
            for f in facts.schema
            if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
        ]
    spread = F.lit(False)
    for key in keys:
        spread = spread | F.col(key).isNull()
    hot = list(hot_keys)
    if hot:
        spread = spread | F.col(keys[0]).isin(hot)
    often = None
    if counted is not None:
        by = list(counted_by or keys)
        kinds = [[frame.schema[k].dataType for k in by] for frame in (facts, lookup, counted)]
        if kinds[0] == kinds[1] == kinds[2]:  # equal keys of unlike types have unlike hashes
            often = F.array_contains(hot_hashes(counted, by), F.xxhash64(*by))
            spread = spread | often
    row_slot = F.pmod(F.xxhash64(*spread_by), F.lit(slots)).cast("int") if spread_by else F.lit(0)
    left = facts.withColumn(_SLOT, F.when(spread, row_slot).otherwise(0))

    lookup_slots = F.array(F.lit(0))
    known = [F.col(keys[0]).isin(hot)] if hot else []
    for repeated in [*known, *([] if often is None else [often])]:
        every = F.sequence(F.lit(0), F.lit(slots - 1))
        lookup_slots = F.when(repeated, every).otherwise(lookup_slots)
    right = lookup.withColumn(_SLOT, F.explode(lookup_slots))
    return left.join(right, [*keys, _SLOT], how).drop(_SLOT)
