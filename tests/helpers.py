from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def bag(df: DataFrame) -> Counter:
    """Rows as a multiset, columns in name order."""
    columns = sorted(df.columns)
    return Counter(tuple(map(_plain, row)) for row in df.select(*columns).collect())


def _plain(value):
    return tuple(value) if isinstance(value, list) else value


def column(df: DataFrame, name: str) -> list:
    return [row[name] for row in df.collect()]


def plan(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """The physical plan after adaptive execution."""
    df.collect()
    return plan(df)
