"""Channel, event and error keys.

The dimensions carry no broadcast hint: Spark broadcasts a table whose size is
under `spark.sql.autoBroadcastJoinThreshold` and shuffles a larger one, where both
sides are then plain shuffles that adaptive execution can split on a hot code.
Each dimension is first brought to one key for each code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tagloom.operators.joins import spread_join


#: The code that each key is looked up by.
CODES = {"chnl_key": "chnl_cd", "event_key": "event_cd", "err_key": "err_cd"}


def _keys(df: DataFrame, code: str, key: str, out: str | None = None) -> DataFrame:
    """One key for each code of the active rows; two different keys of a code end the query."""
    rows = df.filter(F.col("active") == 1) if "active" in df.columns else df
    low, high = F.min(key), F.max(key)
    several = F.raise_error(F.concat(F.lit(f"several values of {key} for {code} "), F.col(code)))
    return rows.groupBy(code).agg(F.when(low != high, several).otherwise(low).alias(key)).withColumnRenamed(code, out or code)


def dimension_keys_left(
    df: DataFrame,
    chnl_map: DataFrame | None,
    event_map: DataFrame | None,
    err_map: DataFrame | None = None,
    event_code: str = "event_cd",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the key of each dimension given; rows without a match keep a null key.

    `event_code` is the column of `df` with the event code.  No row is multiplied.
    `counted` is a frame with the code columns, as frequent as in `df` and cheap to read, in
    which frequent codes are found; their rows are spread.  A code that it lacks is not counted.
    """
    have = set() if counted is None else set(counted.columns)

    def attach(rows: DataFrame, keys: DataFrame, code: str) -> DataFrame:
        return spread_join(rows, keys, [code], counted=counted if code in have else None)

    if chnl_map is not None:
        df = attach(df, _keys(chnl_map, "chnl_cd", "chnl_key"), "chnl_cd")
    if event_map is not None:
        df = attach(df, _keys(event_map, "event_cd", "event_key", event_code), event_code)
    if err_map is not None:
        df = attach(df, _keys(err_map, "err_cd", "err_key"), "err_cd")
    return df


def dimension_keys_inner(
    event_detail: DataFrame, chnl_map: DataFrame, event_map: DataFrame, err_map: DataFrame, counted: DataFrame | None = None
) -> DataFrame:
    """The three keys of each event row that has all of them; `counted` as in `dimension_keys_left`."""
    rows = spread_join(event_detail, _keys(chnl_map, "chnl_cd", "chnl_key"), ["chnl_cd"], "inner", counted=counted)
    rows = spread_join(rows, _keys(event_map, "event_cd", "event_key", "evnt_cd"), ["evnt_cd"], "inner", counted=counted)
    rows = spread_join(rows, _keys(err_map, "err_cd", "err_key"), ["err_cd"], "inner", counted=counted)
    return rows.select("chnl_key", "event_key", "err_key")


def observe_unmatched(df: DataFrame, counts: Observation, codes: Mapping[str, str] = CODES) -> DataFrame:
    """Rows with dimension keys, counted on their way by the action that writes them: rows, and for each key of `codes`
    that `df` has `<key>_unmatched`, the rows with a code and no key, in `counts.get` afterwards."""
    have = {c.lower() for c in df.columns}
    unmatched = [
        F.count_if(F.col(code).isNotNull() & F.col(key).isNull()).alias(f"{key}_unmatched")
        for key, code in codes.items()
        if key in have and code in have
    ]
    return df.observe(counts, F.count(F.lit(1)).alias("rows"), *unmatched)
