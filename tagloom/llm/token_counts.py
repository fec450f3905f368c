"""Token counts: an exact histogram of encoded lengths whose suffix sums answer every context limit.

Documents meet in one row for each distinct length, merged in each task before the shuffle, so nothing after
`length_histogram` grows with the number of documents. A null text counts as an empty one (length 0), repeated
rows count as often as they occur, and an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
import functools
import re

import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import per_text, stored

#: Lengths that share one bin of the two-level suffix sums.
BIN = 1024
#: A text longer than this is encoded in pieces, cut where no token can cross.
PIECE_CHARS = 1 << 20
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer of a rank file."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS):
    """The text in pieces of about `size`, cut only before white space that follows other characters.

    The split pattern never lets a token cross such a place, so the pieces' tokens are the text's tokens.
    """
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def token_lengths(
    docs: DataFrame, ranks: str | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """`keep` and n_tokens, the length of the whole text under the rank file `ranks`."""
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def factory():
        encode = encoding(path).encode_ordinary
        return lambda raw: (sum(len(encode(piece)) for piece in pieces(raw.decode("utf-8", "replace"))),)

    return per_text(docs, factory, "n_tokens long", keep, text)


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row for each distinct length: n_tokens, docs, tokens. A null length is left out.

    The rows are written to the shared folder, as the suffix sums read them twice: texts are encoded once.
    """
    rows = lengths.where(F.col(length).isNotNull()).groupBy(F.col(length).cast("long").alias("n_tokens"))
    counted = rows.agg(F.count("*").alias("docs")).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    return stored(counted, "histogram")


def suffix_sums(histogram: DataFrame, width: int = BIN) -> DataFrame:
    """The histogram with, for each length taken as a context limit:

    docs_at_least, tokens_at_least: documents of that length or more, and their tokens;
    total_truncated: all tokens if every document is cut to the limit;
    total_tokens: all tokens; quantile: the share of documents no longer than the limit.

    The sums go by bins of `width` lengths first, then inside each bin, so that no task orders all lengths.
    """
    binned = histogram.withColumn("_bin", F.floor(F.col("n_tokens") / width))
    later = Window.orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    bins = binned.groupBy("_bin").agg(F.sum("docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
    bins = bins.select(
        "_bin",
        F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_docs_after"),
        F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_tokens_after"),
        F.sum("_docs").over(every).alias("_all_docs"),
        F.sum("_tokens").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("_bin").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = binned.join(bins, "_bin").select(
        "n_tokens",
        "docs",
        "tokens",
        (F.sum("docs").over(inside) + F.col("_docs_after")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("_tokens_after")).alias("tokens_at_least"),
        "total_tokens",
        "_all_docs",
    )
    cut = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    longer = F.col("docs_at_least") - F.col("docs")
    return rows.select(
        "n_tokens",
        "docs",
        "tokens",
        "docs_at_least",
        "tokens_at_least",
        cut.alias("total_truncated"),
        "total_tokens",
        (1 - longer / F.col("_all_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """One row for each context limit, occurring as a length or not: context_limit, docs_cut (longer documents),
    total_truncated. The shortest length of the limit or more holds the answer; beyond all, nothing is cut."""
    if not limits:
        return sums.sparkSession.createDataFrame([], "context_limit long, docs_cut long, total_truncated long")
    found: list[Column] = []
    for k, limit in enumerate(sorted(set(limits))):
        at = F.when(F.col("n_tokens") >= limit, F.struct("n_tokens", "docs_at_least", "tokens_at_least", "docs"))
        found += [F.min(at).alias(f"a{k}")]
    row = sums.agg(F.max("total_tokens").alias("total"), *found)
    cases = []
    for k, limit in enumerate(sorted(set(limits))):
        a, total = F.col(f"a{k}"), F.coalesce(F.col("total"), F.lit(0))
        longer = a.docs_at_least - F.when(a.n_tokens == limit, a.docs).otherwise(0)
        cut = total - a.tokens_at_least + F.lit(limit).cast("long") * a.docs_at_least
        cases.append(
            F.struct(
                F.lit(limit).cast("long").alias("context_limit"),
                F.coalesce(longer, F.lit(0)).cast("long").alias("docs_cut"),
                F.coalesce(cut, total).cast("long").alias("total_truncated"),
            )
        )
    return row.select(F.inline(F.array(*cases)))


def quantile_lengths(sums: DataFrame, shares: list[float]) -> DataFrame:
    """For each share the shortest length that at least this share of the documents does not exceed."""
    found = [F.min(F.when(F.col("quantile") >= p, F.col("n_tokens"))).alias(f"q{k}") for k, p in enumerate(shares)]
    if not found:
        return sums.sparkSession.createDataFrame([], "share double, n_tokens long")
    pairs = [F.struct(F.lit(float(p)).alias("share"), F.col(f"q{k}").alias("n_tokens")) for k, p in enumerate(shares)]
    return sums.agg(*found).select(F.inline(F.array(*pairs)))
