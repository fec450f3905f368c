"""Text functions: presence, masking, clipping, quoting, JSON and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extraction patterns, one per way of quoting.
QUOTE_PATTERNS = {
    "plain": r'"(.*?)"',
    "backslash": r'\\"(.*?)\\"',
    "backslash_apostrophe": r"""\\'"(.*?)"\\'""",
    "doubled": r'""(.*?)\\""',
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: Column | str) -> Column:
    """Comparison form of a text: without outer spaces, lower case."""
    return F.lower(F.trim(_col(c)))


def is_blank(c: Column | str) -> Column:
    """Null or only spaces."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def is_present(c: Column | str) -> Column:
    """Not null, not blank and not the word "null" in any case.

    The bare null test comes first: it is the part a Parquet scan can use.
    """
    c = _col(c)
    return c.isNotNull() & ~norm(c).isin("", "null")


def keep_chars(c: Column | str, drop_pattern: str = "[^0-9]", blank_as_null: bool = True) -> Column:
    """Trimmed text without the characters of `drop_pattern`.

    An empty result is null, so that `coalesce` moves on to its next argument;
    with `blank_as_null=False` it stays an empty text.
    """
    kept = F.regexp_replace(F.trim(_col(c)), drop_pattern, "")
    return F.nullif(kept, F.lit("")) if blank_as_null else kept


def mask_account(c: Column | str) -> Column:
    """Ids of 14 or more characters: first six, a bar, last seven."""
    c = _col(c)
    masked = F.concat(F.substring(c, 1, 6), F.lit("|"), F.substring(c, -7, 7))
    return F.when(F.length(c) >= 14, masked).otherwise(c)


def clip_amount(c: Column | str, keep_exact_12: bool = False) -> Column:
    """Cut an amount whose integer part has more than 12 characters to 12 characters.

    An integer part of exactly 12 characters gives null unless `keep_exact_12`.
    """
    c = _col(c)
    whole = F.length(F.substring_index(c, ".", 1))
    short = (whole <= 12) if keep_exact_12 else (whole < 12)
    return F.when(whole > 12, F.substring(c, 1, 12)).when(short, c)


def quote_before_braces(c: Column | str) -> Column:
    """Put a double quote before the run of closing braces that ends the text.

    The pattern starts only at the head of a run and never gives a brace back,
    so its cost grows with the length of the text and not with its square.
    """
    return F.regexp_replace(_col(c), r"(?<!\})\}++$", '"$0')


def extract_quoted_all(c: Column | str) -> Column:
    """All texts between double quotes, in order, as an array."""
    return F.regexp_extract_all(_col(c), F.lit(QUOTE_PATTERNS["plain"]), F.lit(1))


def extract_quoted(c: Column | str, style: str = "backslash") -> Column:
    """First text between the delimiters of `style`; an empty text if there is none."""
    return F.regexp_extract(_col(c), QUOTE_PATTERNS[style], 1)


def row_json(*cols: Column | str) -> Column:
    """JSON text of the given columns; null fields are left out."""
    return F.to_json(F.struct(*[_col(c) for c in cols]))


def pair_map(key: Column | str, value: Column | str) -> Column:
    """Map with one entry; null where the key is null, which no map can hold."""
    key = _col(key)
    return F.when(key.isNotNull(), F.create_map(key, _col(value)))


def lower_set(values: Sequence[str]) -> list[str]:
    """Literals in comparison form, for use against `norm`."""
    return [v.strip(" ").lower() for v in values]
