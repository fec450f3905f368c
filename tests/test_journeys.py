from __future__ import annotations

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from helpers import bag

from tagloom.operators import journeys

SCHEMA = "journey_id long, evnt_ed string, emplx_jrny_attrb string, flow_num int, operator string, IncompleteMap string"


def reasons_of(rows) -> dict:
    """Broken rules per journey, row by row in plain Python."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = {}
    for key, group in groups.items():
        attributes = {r[2] for r in group if r[2] is not None}
        broken = []
        if any(r[5] == "N" for r in group):
            broken.append("J1")
        if {"And", "Or"} <= attributes:
            broken.append("J2")
        if attributes - {"And", "Or"}:
            broken.append("J2b")
        if any(r[4] is not None and r[4] not in journeys.VALID_OPERATORS for r in group):
            broken.append("J3")
        if len({(r[1], r[2], r[3]) for r in group}) < len(group):
            broken.append("J4")
        if broken and key is not None:
            out[key] = broken
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    kept, removed = journeys.validate_journeys(df)
    want = reasons_of(rows)
    assert bag(kept) + bag(removed.select(*df.columns)) == bag(df)
    assert {r.journey_id: r.reasons for r in removed.collect()} == want
    assert not {r.journey_id for r in kept.collect()} & set(want)
    assert journeys.label_journeys(df).count() == df.count()


def test_each_rule(spark):
    check(
        spark,
        [
            (1, "a", "And", 1, "EQ", "N"), (1, "a", "And", 2, "EQ", "Y"),
            (2, "a", "And", 1, "EQ", "Y"), (2, "a", "Or", 2, "EQ", "Y"),
            (3, "a", "Xor", 1, "EQ", "Y"),
            (4, "a", "And", 1, "XX", "Y"), (4, "b", "And", 1, "LK", "Y"),
            (5, "a", "And", 1, "EQ", "Y"), (5, "a", "And", 1, "GT", "Y"),
            (6, "a", "And", 1, "EQ", "Y"), (6, "b", "And", 1, "B!", None),
            # nulls break nothing, but equal rows with nulls are repeats
            (7, "a", None, 1, None, None), (7, "a", "And", None, "EQ", "Y"),
            (8, None, None, None, "EQ", "Y"), (8, None, None, None, "EQ", "Y"),
            (None, "a", "Xor", 1, "XX", "N"),
            # the same step in another journey is no repeat
            (9, "a", "And", 1, "EQ", "Y"),
        ],
    )


def test_other_attributes_can_be_allowed(spark):
    df = spark.createDataFrame([(3, "a", "Xor", 1, "EQ", "Y")], SCHEMA)
    kept, removed = journeys.validate_journeys(df, other_attributes=False)
    assert (kept.count(), removed.count()) == (1, 0)


row = st.tuples(
    st.sampled_from([None, *range(12)]),
    st.sampled_from([None, "a", "b", "c"]),
    st.sampled_from([None, "And", "And", "And", "Or", "Xor"]),
    st.sampled_from([None, *range(8)]),
    st.sampled_from([None, "EQ", "GT", "LT", "NE", "LK", "XX"]),
    st.sampled_from([None, "Y", "Y", "Y", "Y", "N"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=60))
def test_equals_plain_python(spark, rows):
    check(spark, rows)
