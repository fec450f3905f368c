"""Journey validation: whole journeys are kept or removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tagloom.operators.joins import spread_join
from tagloom.operators.key_filter import filtered

# Operators a journey may use, and attributes that link its steps.
VALID_OPERATORS = ("EQ", "NE", "GT", "LT", "GTEQ", "LTEQ", "LK", "NIK", "B!")
VALID_ATTRIBUTES = ("And", "Or")

RULES = {
    "J1": "incomplete map",
    "J2": "both And and Or",
    "J2b": "attribute other than And and Or",
    "J3": "operator not allowed",
    "J4": "repeated event, attribute and flow number",
}


def journey_flags(df: DataFrame, other_attributes: bool = True) -> DataFrame:
    """One row per journey with a boolean per rule of `RULES`.

    The rows of a journey are first merged by (event, attribute, flow number), which
    shows repeats, nulls included, and shrinks a long journey before it is shuffled;
    the second grouping merges flags only, again before the shuffle.  A null never
    breaks a rule by itself.
    """
    attribute = F.col("emplx_jrny_attrb")
    steps = df.groupBy("journey_id", "evnt_ed", "emplx_jrny_attrb", "flow_num").agg(
        (F.count("*") > 1).alias("_repeat"),
        F.max(F.col("IncompleteMap") == "N").alias("_incomplete"),
        F.max(~F.col("operator").isin(*VALID_OPERATORS)).alias("_operator"),
    )

    def any_of(condition: Column) -> Column:
        return F.coalesce(F.max(condition), F.lit(False))

    odd = ~attribute.isin(*VALID_ATTRIBUTES) if other_attributes else F.lit(False)
    return steps.groupBy("journey_id").agg(
        any_of(F.col("_incomplete")).alias("J1"),
        (any_of(attribute == "And") & any_of(attribute == "Or")).alias("J2"),
        any_of(odd).alias("J2b"),
        any_of(F.col("_operator")).alias("J3"),
        any_of(F.col("_repeat")).alias("J4"),
    )


def broken_journeys(df: DataFrame, other_attributes: bool = True) -> DataFrame:
    """Journeys that break a rule, with the names of the broken rules as `reasons`."""
    named = F.array(*[F.when(F.col(rule), F.lit(rule)) for rule in RULES])
    return (
        journey_flags(df, other_attributes)
        .filter(" OR ".join(RULES))
        .select("journey_id", F.array_compact(named).alias("reasons"))
    )


def label_journeys(df: DataFrame, other_attributes: bool = True) -> DataFrame:
    """Every row with `reasons`, the rules its journey breaks; empty for a row that is kept.

    One join labels all rows, so that one write can split them.  A row without journey
    id belongs to no journey and is kept.
    """
    broken = broken_journeys(df, other_attributes)
    none = F.array().cast("array<string>")
    return spread_join(df, broken, ["journey_id"]).select(*df.columns, F.coalesce("reasons", none).alias("reasons"))


def validate_journeys(df: DataFrame, other_attributes: bool = True) -> tuple[DataFrame, DataFrame]:
    """Kept and removed rows; together they are the input, the removed ones with `reasons`.

    Both are filters of `label_journeys`; write that frame once where both are wanted.
    """
    labelled = label_journeys(df, other_attributes)
    kept = labelled.filter(F.size("reasons") == 0).select(*df.columns)
    return kept, labelled.filter(F.size("reasons") > 0)


def removed_journeys(df: DataFrame, expected: int, other_attributes: bool = True) -> DataFrame:
    """The removed rows alone, with their `reasons`: rows of journeys that break no rule go before the shuffle.

    `expected` is about the number of broken journeys; see `key_filter`.
    """
    broken = broken_journeys(df, other_attributes)
    rows = filtered(df, broken, ["journey_id"], expected)
    return spread_join(rows, broken, ["journey_id"], "inner").select(*df.columns, "reasons")


def observe_journeys(labelled: DataFrame, counts: Observation) -> DataFrame:
    """`label_journeys` rows, counted on their way by the action that writes them: rows, kept, removed, and the rows
    whose journey breaks each rule, in `counts.get` afterwards."""
    kept = F.size("reasons") == 0
    rules = [F.count_if(F.array_contains("reasons", rule)).alias(rule) for rule in RULES]
    totals = F.count(F.lit(1)).alias("rows"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("removed")
    return labelled.observe(counts, *totals, *rules)
