"""Main request rows: normalising, enriching, newest day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.fields import NO_ID
from tagloom.functions.text import norm
from tagloom.operators.details import of_day
from tagloom.operators.joins import colocated_join, spread_join


def normalise_main(main: DataFrame, business_date: date | str | None = None) -> DataFrame:
    """Trimmed ids with -99 for a missing one; an absent error text reads `none`."""
    no_error = F.coalesce(norm("err_msg_txt"), F.lit("none")).isin("none", "null")
    return of_day(main, business_date).withColumns(
        {
            "cus_idr": F.coalesce(F.trim("cus_idr"), F.lit(NO_ID)),
            "mmb_num": F.coalesce(F.trim("mmb_num"), F.lit(NO_ID)),
            "err_msg_txt": F.when(no_error, F.lit("none")).otherwise(F.trim("err_msg_txt")),
        }
    )


def enrich_main(
    details_wide: DataFrame,
    main: DataFrame,
    suffix: str = "_t",
    by: Sequence[str] = ("uid",),
    colocated_by: str | None = None,
) -> DataFrame:
    """Every main row with the columns of its grouped details, null where it has none.

    `by` is what the details were grouped by.  A detail column that is also a main
    column gets `suffix`.  `colocated_by` is the column that both sides lie in buckets of,
    if they do; the join then moves no row.
    """
    taken = {c.lower() for c in main.columns}
    renamed = {
        c: f"{c}{suffix}" for c in details_wide.columns if c not in by and c.lower() in taken
    }
    clash = [n for n in renamed.values() if n.lower() in taken | {c.lower() for c in details_wide.columns}]
    if clash:
        raise ValueError(f"detail columns already there: {', '.join(clash)}")
    lookup = details_wide.withColumnsRenamed(renamed)
    if colocated_by:
        return colocated_join(main, lookup, list(by), colocated_by)
    return spread_join(main, lookup, list(by), "left")


def latest_partition(df: DataFrame, main: DataFrame | None = None) -> DataFrame:
    """Rows of the greatest `log_dte` of `main` (of `df` itself if not given).

    The date is a scalar subquery of the same query: nothing is read to the driver
    while the plan is built, and the scan gets the date as a filter.  The maximum itself
    reads the column of every row; for a catalog table `tables.read_newest` takes it from
    the catalog instead.
    """
    newest = (df if main is None else main).agg(F.max("log_dte").alias("log_dte"))
    return df.filter(F.col("log_dte") == newest.scalar())
