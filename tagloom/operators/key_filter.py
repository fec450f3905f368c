"""A Bloom filter of join keys, applied to the large side before it is shuffled.

Where the small side of a join is over the broadcast threshold, both sides are shuffled whole, though most rows of the
large one may have no partner. The filter is an array of 64-bit words, made by one aggregate of the small side and looked
up by built-in expressions in the stage of the scan. It never drops a row with a partner; rows it lets through without one
are dropped by the join that follows. Its size is bounded by the caller, not by the data: more keys than expected make it
let more rows through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each expected key, and places a key sets: about one row in a hundred passes without a partner.
BITS, PLACES = 10, 5
#: The longest filter, 16 MB, for some 13 million keys.
MOST_BITS = 1 << 27


def filter_bits(expected: int) -> int:
    """Bits for so many keys: a power of two, from 64 to MOST_BITS."""
    return min(MOST_BITS, max(64, 1 << (max(1, expected) * BITS - 1).bit_length()))


def _places(keys: Sequence[Column], bits: int) -> list[Column]:
    """The bits that a key sets; null where a part of it is null."""
    known = F.lit(True)
    for key in keys:
        known = known & key.isNotNull()
    # two halves of one hash stand for any number of hashes
    whole = F.xxhash64(*keys)
    low, high = whole.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(whole, 32)
    return [F.when(known, F.pmod(low + i * high, F.lit(bits))) for i in range(PLACES)]


def _mask(place: Column) -> Column:
    """The bit of a place in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def key_words(side: DataFrame, keys: Sequence[Column | str], expected: int) -> DataFrame:
    """One row with `words`, the filter of the keys of `side`."""
    bits = filter_bits(expected)
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    places = side.select(F.explode(F.array(*_places(columns, bits))).alias("_bit")).where(F.col("_bit").isNotNull())
    words = places.groupBy(F.floor(F.col("_bit") / 64).alias("id")).agg(F.bit_or(_mask(F.col("_bit"))).alias("_word"))
    every = side.sparkSession.range(bits // 64).join(words, "id", "left")
    # in order, absent words as zero; no more of them than the filter has
    pairs = F.sort_array(F.collect_list(F.struct("id", F.coalesce("_word", F.lit(0).cast("long")).alias("_word"))))
    return every.agg(F.transform(pairs, lambda p: p["_word"]).alias("words"))


def may_have_partner(keys: Sequence[Column | str], words: Column, expected: int) -> Column:
    """False only where the key is in no row that the filter was made of, or null."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    found = F.lit(True)
    for place in _places(columns, filter_bits(expected)):
        word = F.get(words, F.floor(place / 64).cast("int"))
        found = found & (word.bitwiseAND(_mask(place)) != 0)
    return F.coalesce(found, F.lit(False))


def filtered(facts: DataFrame, side: DataFrame, keys: Sequence[str], expected: int) -> DataFrame:
    """The rows of `facts` whose `keys` may be among those of `side`, for an inner or semi join to it."""
    words = key_words(side, keys, expected).scalar()
    return facts.where(may_have_partner(keys, words, expected))
