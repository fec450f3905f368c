"""Field rules that add or replace columns of one row: tags, accounts, members, errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import is_blank, keep_chars, lower_set, norm

# Categories, paths, ids and placeholders of the audit domain.
GROUP_PAYMENT = "/olb/bulkpay/grouppaymentstepfour.json"
STRIPPED_CATEGORIES = (
    "/olb/bulkpay/grouppaymentstepfour.json",
    "/olb/fspay/mrp/payments.json",
)
SUFFIX_PATTERN = r"\.[0-9]+"
INSTRUCTION_PATH = "/olb/ku/pay/grouppaymentsstepfour.json"
PAYMENT_PATH = "/olb/ku/pay/payments.json"
PLACEHOLDER_MEMBER = "999999999999"
NO_ID = "-99"
EVENT_ID = "10001028"
CHANNEL = "OLB"


def normalise_tagname(
    df: DataFrame,
    categories: Sequence[str] = STRIPPED_CATEGORIES,
    strip_pattern: str = SUFFIX_PATTERN,
    replacement: str = "",
) -> DataFrame:
    """Take `strip_pattern` out of the tag name in the listed categories only."""
    listed = norm("acn_cat_nme").isin(lower_set(categories))
    stripped = F.regexp_replace(F.trim("tagname"), strip_pattern, replacement)
    return df.withColumn("tagname", F.when(listed, stripped).otherwise(F.col("tagname")))


def categorise_tag(df: DataFrame) -> DataFrame:
    """Tag name by category: the first of two fixed paths that fits, else without digits."""
    category = norm("acn_cat_nme")
    return df.withColumn(
        "tagname",
        F.when(category.contains("instn"), F.lit(INSTRUCTION_PATH))
        .when(category.contains("paym"), F.lit(PAYMENT_PATH))
        .otherwise(F.regexp_replace("tagname", "[0-9]", "")),
    )


def tag_volume(
    df: DataFrame, category: str = GROUP_PAYMENT, out: str = "vol", separator: str = "."
) -> DataFrame:
    """Number behind the first separator of the tag name in the group payment category, else 1.

    Has to run before `normalise_tagname`, which takes that number away.
    """
    name = F.trim("tagname")
    second = F.substring_index(F.substring_index(name, separator, 2), separator, -1)
    numbered = (norm("acn_cat_nme") == category.lower()) & name.contains(separator)
    return df.withColumn(out, F.coalesce(F.when(numbered, second.try_cast("int")), F.lit(1)))


def to_account_id(df: DataFrame, out: str = "v_to_acct_id_t") -> DataFrame:
    """The three sort codes in a row when all are there, else `to_acct_id`."""
    parts = ["sortcode1_t", "sortcode2_t", "sortcode3_t"]
    # concat is null as soon as one part is null
    return df.withColumn(out, F.coalesce(F.concat(*[F.trim(p) for p in parts]), F.col("to_acct_id")))


def from_account_id(df: DataFrame, blank_as_null: bool = True, out: str = "fr_acct_id") -> DataFrame:
    """First of four fields that holds digits; the last one keeps its decimal point."""
    return df.withColumn(
        out,
        F.coalesce(
            keep_chars("fr_acct_id", "[^0-9]", blank_as_null),
            keep_chars("prd_key", "[^0-9]", blank_as_null),
            keep_chars("src_idw_tp", "[^0-9]", blank_as_null),
            keep_chars("val", "[^0-9.]", blank_as_null),
        ),
    )


def member_id_placeholder(
    df: DataFrame, member: str = "mmb_num", detail: str = "mmb_num_t", out: str = "mmb_num"
) -> DataFrame:
    """Take the detail member where the main one is the placeholder, else the main one."""
    use_detail = (F.trim(member) == PLACEHOLDER_MEMBER) & ~is_blank(detail)
    return df.withColumn(out, F.when(use_detail, F.trim(detail)).otherwise(F.col(member)))


def member_id_prefer_detail(
    df: DataFrame, member: str = "mmb_num", detail: str = "mmb_num_t", out: str = "cust_mbr_id"
) -> DataFrame:
    """Take the detail member unless the main one is the placeholder or missing.

    The opposite choice of `member_id_placeholder`; the two are kept apart on purpose.
    """
    use_detail = (F.trim(member) != PLACEHOLDER_MEMBER) & ~is_blank(detail)
    return df.withColumn(
        out,
        F.when(use_detail, F.trim(detail)).otherwise(F.coalesce(F.trim(member), F.lit(NO_ID))),
    )


def event_constants(
    df: DataFrame, category: str = "acn_cat_nme", channel: str = CHANNEL, event_id: str = EVENT_ID
) -> DataFrame:
    """Fixed event id and channel, event code from the category."""
    return df.withColumns(
        {
            "event_id": F.lit(event_id),
            "chnl_cd": F.lit(channel),
            "event_cd": F.trim(category),
        }
    )


def error_code(
    df: DataFrame, text: str = "err_msg_txt", stopflow: str = "stopflow_t", out: str = "err_cd"
) -> DataFrame:
    """Short error text as code, the stop-flow value where there is no error, else null.

    The word "null" counts as a text here; run `normalise_main` first to treat it as none.
    """
    short = F.length(F.trim(text)) < 20
    is_none = norm(text) == "none"
    return df.withColumn(
        out,
        F.when(short & ~is_none, F.trim(text)).when(F.col(text).isNull() | is_none, F.trim(stopflow)),
    )


def result_flag(df: DataFrame, text: str = "err_msg_txt", out: str = "result_flag") -> DataFrame:
    """`Success` for the exact texts none and null, `Failure` for all others and for null.

    Works on the text as it stands: on the raw log a null is a failure, after
    `normalise_main` it reads `none` and is a success.
    """
    good = F.trim(text).isin("none", "null")
    return df.withColumn(out, F.when(good, F.lit("Success")).otherwise(F.lit("Failure")))
