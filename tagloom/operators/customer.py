"""Customer resolution: one link per member, customer id of each request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.fields import NO_ID, PLACEHOLDER_MEMBER
from tagloom.functions.text import is_blank
from tagloom.operators.details import first_row
from tagloom.operators.joins import find_hot_keys, spread_join

# Members that stand for "unknown" and so are on a large share of the rows.
HOT_MEMBERS = (NO_ID, PLACEHOLDER_MEMBER)


def _by_member(cust_link: DataFrame) -> DataFrame:
    """Links with their member as it is looked up: trimmed, so that one member is one key."""
    return cust_link.withColumn("mmb_lnk_mmb_num", F.trim(F.col("mmb_lnk_mmb_num").cast("string")))


def active_customer_link(cust_link: DataFrame) -> DataFrame:
    """The link of each member that counts: active status, not ended.

    Personal links (P) go before business links (B, file types 02 and 03), then the
    latest start, then the smallest customer id.
    """
    links = _by_member(cust_link).filter(
        (F.upper(F.trim("mmb_lnk_sts")) == "AC")
        & F.col("mmb_lnk_mmb_num").isNotNull()
        & is_blank("mmb_lnk_end_dte")
    ).withColumn(
        "priority",
        F.when(F.trim("mmb_lnk_fls_type").isin("02", "03"), F.lit("B")).otherwise(F.lit("P")),
    )
    order = [
        F.col("priority").desc(),
        F.col("eff_start_date").desc_nulls_last(),
        F.col("cus_idr").asc_nulls_first(),
        F.col("mmb_lnk_fls_type").asc_nulls_first(),
    ]
    return first_row(links, ["mmb_lnk_mmb_num"], order)


def latest_customer_link(cust_link: DataFrame) -> DataFrame:
    """The last known customer of each member among its active links.

    Exactly one row per member: latest start, then smallest customer id.
    """
    links = _by_member(cust_link).filter(
        (F.upper(F.trim("mmb_lnk_sts")) == "AC")
        & (F.trim(F.col("active").cast("string")) == "1")
        & F.col("mmb_lnk_mmb_num").isNotNull()
        & F.col("cus_idr").isNotNull()
    ).select("mmb_lnk_mmb_num", "cus_idr", "eff_start_date")
    order = [F.col("eff_start_date").desc_nulls_last(), F.col("cus_idr").asc()]
    return first_row(links, ["mmb_lnk_mmb_num"], order).select("mmb_lnk_mmb_num", "cus_idr")


def customer_id(main: DataFrame, link: DataFrame, find_hot: bool = False) -> DataFrame:
    """Every main row with the customer of its member.

    `cus_idr` is the trimmed id or -99, `cust_id` the same as a number, with -99 for
    an id that is none.  A `cus_idr` of the main row itself moves to `main_cus_idr`.
    `link` holds one row per trimmed member.  The placeholders are always spread;
    `find_hot` reads the members once, before, and spreads all that are on many rows.
    """
    if "cus_idr" in main.columns:
        main = main.withColumnRenamed("cus_idr", "main_cus_idr")
    keyed = main.withColumn("_member", F.trim("mmb_num"))
    lookup = link.select(
        F.trim(F.col("mmb_lnk_mmb_num").cast("string")).alias("_member"), F.trim("cus_idr").alias("cus_idr")
    )
    hot = list(HOT_MEMBERS)
    if find_hot:
        hot = list(dict.fromkeys([*hot, *find_hot_keys(keyed, "_member")]))
    joined = spread_join(keyed, lookup, ["_member"], "left", hot).drop("_member")
    return joined.withColumns(
        {
            "cus_idr": F.coalesce("cus_idr", F.lit(NO_ID)),
            "cust_id": F.coalesce(F.col("cus_idr").try_cast("bigint"), F.lit(int(NO_ID)).cast("bigint")),
        }
    )
