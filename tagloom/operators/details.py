"""Detail rows: cleaning, deduplication, transposition, grouping, event matching."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tagloom.functions.text import is_blank, is_present, keep_chars, norm
from tagloom.operators.joins import spread_join
from tagloom.operators.key_filter import filtered

DEDUP_KEY = ("uid", "log_dte", "tagname", "tagvalue")

# Of rows with equal keys the smallest by these columns stays, whatever else a flow needs
# of them; columns beyond these decide last, by name.
TIE_BREAK = ("acn_cat_nme", "mmb_num", "ses_idr", "log_tme", "acn_nme", "log_millisec", "msg_typ")


def of_day(df: DataFrame, business_date: date | str | Column | None) -> DataFrame:
    """Rows of one business date; the bare column lets the scan prune partitions.

    The date is an argument; `F.current_date()` gives the day of the run.
    """
    if business_date is None:
        return df
    return df.filter(F.col("log_dte") == F.lit(business_date).cast("date"))


def clean_details(
    details: DataFrame, business_date: date | str | Column | None = None
) -> DataFrame:
    """Detail rows with a usable tag value, of one business date if given."""
    return of_day(details, business_date).filter(is_present("tagvalue"))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key.  Spark cuts each key to one row per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_details(
    df: DataFrame,
    key: Sequence[str] = DEDUP_KEY,
    order_by: Sequence[str] = (),
    greatest: str | None = None,
) -> DataFrame:
    """One row per `key`: the smallest by `order_by`, then by `TIE_BREAK`, then by all other columns.

    `greatest` names a column whose greatest value comes before all of that.
    """
    first = [*order_by, *TIE_BREAK, *sorted(df.columns)]
    rest = [c for c in dict.fromkeys(first) if c in df.columns and c not in key]
    if not rest:
        return df.dropDuplicates(list(key))
    head = [F.col(greatest).desc_nulls_last()] if greatest else []
    return first_row(df, key, head + [F.col(c).asc_nulls_first() for c in rest if c != greatest])


#: Up to so many rules become expressions of the query; a longer table is joined.
COMPILED_RULES = 100


class RuleNames(NamedTuple):
    """What a rule table names: output columns, pairs of tested columns, value columns; the rules where they are few."""

    targets: list[str]
    tests: list[tuple[str, str]]
    values: list[str]
    few: list[Row] | None = None


def _named(rules: DataFrame) -> DataFrame:
    """Rules with an output column, column names in lower case, the two tests in name order."""
    first, second = (F.coalesce(F.lower(F.trim(f"filter_col{i}")), F.lit("")) for i in (1, 2))
    swap = first > second
    return rules.filter(F.coalesce("new_col", F.lit("")) != "").select(
        F.when(swap, second).otherwise(first).alias("_col1"),
        F.when(swap, first).otherwise(second).alias("_col2"),
        F.when(swap, F.col("filter_condn2")).otherwise(F.col("filter_condn1")).alias("_test1"),
        F.when(swap, F.col("filter_condn1")).otherwise(F.col("filter_condn2")).alias("_test2"),
        F.coalesce(F.lower(F.trim("value_col")), F.lit("")).alias("_from"),
        F.col("new_col").alias("_target"),
    )


def rule_names(rules: DataFrame, df: DataFrame) -> RuleNames:
    """The names in the rules, after a check that they are columns of `df`.

    Output columns have to be known while the plan is built.  A short rule table, up to
    `COMPILED_RULES`, is read whole for that; of a longer one, only the names are, as
    many as there are columns.
    """
    few = _named(rules).limit(COMPILED_RULES + 1).collect()
    if len(few) <= COMPILED_RULES:
        tests = sorted({(r._col1, r._col2) for r in few})
        found = RuleNames(sorted({r._target for r in few}), tests, sorted({r._from for r in few}), few)
    else:
        row = _named(rules).agg(
            F.sort_array(F.collect_set("_target")).alias("targets"),
            F.sort_array(F.collect_set(F.struct("_col1", "_col2"))).alias("tests"),
            F.sort_array(F.collect_set("_from")).alias("values"),
        ).first()
        found = RuleNames(row.targets, [tuple(t) for t in row.tests], row["values"])
    have = {c.lower() for c in df.columns}
    for name in [*found.values, *[c for test in found.tests for c in test]]:
        if name not in have:
            raise ValueError(f"a rule names no column: {name}")
    return found


def _live(rules: DataFrame) -> DataFrame:
    """Rules that can match: no null condition, one condition for one column."""
    possible = (F.col("_col1") != F.col("_col2")) | (F.col("_test1") == F.col("_test2"))
    return _named(rules).filter(F.col("_test1").isNotNull() & F.col("_test2").isNotNull() & possible)


def _can_match(rule: Row) -> bool:
    """As `_live`, of a rule that has been read."""
    if rule._test1 is None or rule._test2 is None:
        return False
    return rule._col1 != rule._col2 or rule._test1 == rule._test2


def _usable_by_rules(rules: Sequence[Row], key_names: set[str]) -> Column:
    """Whether some rule may match a row, as far as its key columns tell."""
    tests: dict[tuple[str, ...], set[tuple[str, ...]]] = {}
    for r in filter(_can_match, rules):
        looked_at = {c: v for c, v in ((r._col1, r._test1), (r._col2, r._test2)) if c in key_names}
        tests.setdefault(tuple(looked_at), set()).add(tuple(looked_at.values()))
    usable = F.lit(False)
    for columns, values in tests.items():
        if len(columns) == 1:
            usable = usable | norm(columns[0]).isin([v[0] for v in sorted(values)])
        else:
            for value in sorted(values):
                usable = usable | reduce(Column.__and__, [norm(c) == v for c, v in zip(columns, value)])
    return F.coalesce(usable, F.lit(False))


def cut_for_rules(
    df: DataFrame,
    rules: DataFrame,
    key: Sequence[str] = DEDUP_KEY,
    keep: Sequence[str] = (),
    names: RuleNames | None = None,
) -> DataFrame:
    """Empty the rows that no rule can use, before they are shuffled.

    In a row that no rule can match by its key columns everything but the request, the
    day and `keep` becomes null, so the next deduplication merges such rows of a request
    into one, in each task before the shuffle.  The other rows stay whole: which of them
    a deduplication keeps does not depend on the rules.
    """
    names, key_names = names or rule_names(rules, df), {c.lower() for c in key}
    looked_at = {test: tuple(dict.fromkeys(c for c in test if c in key_names)) for test in names.tests}
    if () in looked_at.values():  # a rule that looks at no key column may match any row
        return df
    if names.few is not None:
        return _emptied(df, _usable_by_rules(names.few, key_names), keep)
    live, rows, usable = _live(rules), df, F.lit(False)
    for i, columns in enumerate(sorted(set(looked_at.values()))):
        tables = [
            live.filter((F.col("_col1") == a) & (F.col("_col2") == b)).select(
                *[F.col("_test1" if c == a else "_test2").alias(f"_cut{n}") for n, c in enumerate(columns)]
            )
            for (a, b), used in looked_at.items()
            if used == columns
        ]
        known = reduce(DataFrame.union, tables).distinct().withColumn(f"_usable{i}", F.lit(True))
        tests = {f"_cut{n}": norm(c) for n, c in enumerate(columns)}
        rows = spread_join(rows.withColumns(tests), known, list(tests), spread_by=list(df.columns)).drop(*tests)
        usable = usable | F.coalesce(f"_usable{i}", F.lit(False))
    return _emptied(rows, usable, keep).select(*df.columns)


def _emptied(rows: DataFrame, usable: Column, keep: Sequence[str]) -> DataFrame:
    """Rows that are not usable keep the request, the day and `keep` alone."""
    fixed = {"uid", "log_dte", *[c.lower() for c in keep]}
    columns = [F.col(c) if c.lower() in fixed else F.when(F.col("_usable"), F.col(c)).alias(c) for c in rows.columns]
    return rows.withColumn("_usable", usable).select(*columns)


def transpose_by_rules(
    details: DataFrame,
    rules: DataFrame,
    by: Sequence[str] = ("uid",),
    carry: Sequence[str] = (),
    names: RuleNames | None = None,
) -> DataFrame:
    """Turn tags into columns as a table of normalised rules says, one row per `by`.

    A rule reads: where `filter_col1` equals `filter_condn1` and `filter_col2`
    equals `filter_condn2`, column `value_col` goes into output column `new_col`.
    Several rules may share a target; the greatest value wins.  A rule with a null
    condition never matches but still gives its column.  `carry` names columns whose
    greatest value is added.  `names` are those of `rule_names`, if read already.

    Up to `COMPILED_RULES` rules are conditional maxima of one aggregate.  More are
    joined to the rows, so their number is not bounded.  Matches are then
    merged to one short row per `by` and target; after that a group has no more rows
    than there are targets, however hot it was, and becomes one row.
    """
    names = names or rule_names(rules, details)
    both = {c.lower() for c in (*by, *carry)} & set(names.targets)
    if both:
        raise ValueError(f"rule target is a grouping or carried column: {sorted(both)}")
    if not names.targets:
        totals = [F.max(c).alias(c) for c in carry]
        return details.groupBy(*by).agg(*totals) if totals else details.select(*by).distinct()

    if names.few is not None:
        return _compiled(details, names, by, carry)
    shape = F.coalesce(*[F.when((F.col("_col1") == a) & (F.col("_col2") == b), F.lit(i)) for i, (a, b) in enumerate(names.tests)])
    wanted = (
        _live(rules)
        .groupBy(shape.alias("_shape"), "_test1", "_test2")
        .agg(F.collect_set(F.struct("_target", "_from")).alias("_hits"))
    )
    looks = [
        F.struct(F.lit(i).alias("_shape"), norm(a).alias("_test1"), norm(b).alias("_test2"))
        for i, (a, b) in enumerate(names.tests)
    ]
    values = [F.col(v).cast("string").alias(f"_from_{v}") for v in names.values]
    # a row that no rule can match, such as one that was emptied, is there once and meets no rule
    possible = F.filter(F.array(*looks), lambda t: t["_test1"].isNotNull() & t["_test2"].isNotNull())
    long = details.select(*by, *carry, *values, F.inline_outer(possible))
    matched = spread_join(long, wanted, ["_shape", "_test1", "_test2"])
    value = F.coalesce(*[F.when(F.col("_hit._from") == v, F.col(f"_from_{v}")) for v in names.values])
    merged = (
        matched.select(*by, *carry, *[f"_from_{v}" for v in names.values], F.explode_outer("_hits").alias("_hit"))
        .groupBy(*by, F.col("_hit._target").alias("_target"))
        .agg(F.max(value).alias("_value"), *[F.max(c).alias(c) for c in carry])
    )
    pair = F.when(F.col("_target").isNotNull(), F.struct("_target", "_value"))
    gathered = merged.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(pair)).alias("_found"), *[F.max(c).alias(c) for c in carry]
    )
    wide = [F.try_element_at("_found", F.lit(t)).alias(t) for t in names.targets]
    return gathered.select(*by, *wide, *carry)


def _compiled(details: DataFrame, names: RuleNames, by: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """One aggregate with the rules as expressions; the comparison form of a tested column is made once a row."""
    tested = {c: f"_norm_{c}" for c in sorted({c for test in names.tests for c in test})}
    wide = []
    for target in names.targets:
        values = [
            F.when((F.col(tested[r._col1]) == r._test1) & (F.col(tested[r._col2]) == r._test2), F.col(r._from).cast("string"))
            for r in names.few
            if r._target == target and _can_match(r)
        ]
        value = F.greatest(*values) if len(values) > 1 else (values or [F.lit(None).cast("string")])[0]
        wide.append(F.max(value).alias(target))
    rows = details.withColumns({name: norm(c) for c, name in tested.items()})
    return rows.groupBy(*by).agg(*wide, *[F.max(c).alias(c) for c in carry])


def group_details(df: DataFrame, by: Sequence[str] = ("uid",)) -> DataFrame:
    """One row per `by` with the greatest value of every other column."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(*[F.max(c).alias(c) for c in rest])


def tag_pairs(
    details: DataFrame, tag_rows: DataFrame, expected_tags: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Distinct (uid, tagname, tagvalue) whose tag is configured for the row's own event.

    `tag_rows` has a row per event code and tag (`evnt_cd`, `tag`).  This long relation
    is the one to go on with: it has no group of its own, however much a request holds.
    `expected_tags`, about the number of those rows, puts a filter of them before the
    shuffle: for more of them than Spark broadcasts.  `counted`, detail rows before an
    expensive step such as a deduplication, is read for tags of an event that are on many
    rows; these are spread.
    """
    wanted = tag_rows.select(norm("evnt_cd").alias("_event"), norm("tag").alias("_tag"))
    rows = details.select(
        "uid", "tagname", "tagvalue", norm("acn_cat_nme").alias("_event"), norm("tagname").alias("_tag")
    )
    if expected_tags is not None:
        rows = filtered(rows, wanted, ["_event", "_tag"], expected_tags)
    if counted is None:
        matched = rows.join(wanted, ["_event", "_tag"], "left_semi")
    else:
        counted = counted.select(norm("acn_cat_nme").alias("_event"), norm("tagname").alias("_tag"))
        matched = spread_join(rows, wanted.distinct(), ["_event", "_tag"], "left_semi", counted=counted)
    return matched.select("uid", "tagname", "tagvalue").distinct()


def tag_names(details: DataFrame, tag_rows: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Distinct (uid, tagname) of the tag pairs."""
    return tag_pairs(details, tag_rows, counted=counted).select("uid", "tagname").distinct()


#: Pairs that one array of `tag_vector` should hold at most.
PART_PAIRS = 100_000


def parts_for(pairs: DataFrame, most: int = PART_PAIRS) -> int:
    """A number of parts for `tag_vector` and `tag_map` that leaves the largest request of `tag_pairs` about `most`
    pairs in each.  One job; the choice is the caller's, so that the shape of a result does not change by itself."""
    largest = pairs.groupBy("uid").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first().n
    return max(1, -(-(largest or 0) // most))


def _part(parts: int, *columns: str) -> Column:
    """The part of a row, from 0: a function of its own values, the same for every request."""
    text = F.concat_ws("=", *columns)
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % parts).cast("int").alias("part")


def tag_vector(details: DataFrame, tag_rows: DataFrame, parts: int, counted: DataFrame | None = None) -> DataFrame:
    """Per uid and part the sorted array of its (tagname, tagvalue) pairs.

    Every request is dealt to the same number of parts by its pairs, whatever its size: the part of a pair depends on
    `parts` and the pair alone.  An array holds about one of `parts` shares of a request, so a request that may be
    large wants many (see `parts_for`), or the long relation of `tag_pairs`, which has no arrays.
    """
    pairs = tag_pairs(details, tag_rows, counted=counted)
    dealt = pairs.select("uid", "tagname", "tagvalue", _part(parts, "tagname", "tagvalue"))
    return dealt.groupBy("uid", "part").agg(F.sort_array(F.collect_list(F.struct("tagname", "tagvalue"))).alias("tag_vec"))


def tag_map(details: DataFrame, tag_rows: DataFrame, parts: int, counted: DataFrame | None = None) -> DataFrame:
    """Per uid and part, here by tag alone, a map from tag to value, of several values the greatest."""
    pairs = tag_pairs(details, tag_rows, counted=counted).groupBy("uid", "tagname").agg(F.max("tagvalue").alias("tagvalue"))
    return pairs.groupBy("uid", _part(parts, "tagname")).agg(
        F.map_from_entries(F.collect_list(F.struct("tagname", "tagvalue"))).alias("tag_map")
    )


def first_transaction(
    details: DataFrame,
    event_attr_config: DataFrame,
    main: DataFrame,
    order_by: Sequence[Column | str] | None = None,
    expected_tags: int | None = None,
) -> DataFrame:
    """Digits of the first configured amount of each (uid, category), on the main rows.

    First by `order_by`, else by log date, time and millisecond; then by value.  The
    first row is taken before blank amounts are dropped: a blank first amount means
    that the request has none, not that a later one counts.  `expected_tags` as in
    `tag_pairs`, for the amount tags of the configuration.  Few pairs of category and tag
    hold most rows: such pairs are found in the same query and their rows spread.
    """
    if order_by is None:
        order_by = ["log_dte", "log_tme", F.col("log_millisec").try_cast("int")]
    order_by = [F.col(c) if isinstance(c, str) else c for c in order_by]
    wanted = event_attr_config.filter(norm("trgt_col_nm") == "tran_amt").select(
        norm("evnt_cd").alias("_category"), norm("tag_nm").alias("_tag")
    )
    rows = details.select(
        "uid",
        norm("acn_cat_nme").alias("_category"),
        norm("tagname").alias("_tag"),
        F.col("tagvalue").alias("tran_amt"),
        *[c.alias(f"_by_{i}") for i, c in enumerate(order_by)],
    )
    if expected_tags is not None:
        rows = filtered(rows, wanted, ["_category", "_tag"], expected_tags)
    counted = rows.select("_category", "_tag")
    amounts = spread_join(rows, wanted.distinct(), ["_category", "_tag"], "left_semi", counted=counted)
    order = [F.col(f"_by_{i}").asc_nulls_first() for i in range(len(order_by))]
    order.append(F.col("tran_amt").asc_nulls_first())
    first = (
        first_row(amounts, ["uid", "_category"], order)
        .filter(~is_blank("tran_amt"))
        .select(
            "uid",
            "_category",
            keep_chars("tran_amt", blank_as_null=False).alias("tran_amt_first"),
        )
    )
    requests = main.select("uid", "acn_cat_nme", norm("acn_cat_nme").alias("_category"))
    return spread_join(requests, first, ["uid", "_category"], "inner").select(
        "uid", "acn_cat_nme", "tran_amt_first"
    )


def match_event_config(dedup: DataFrame, event_attr_config: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """One row per (uid, event) of the tags joined to their event configuration.

    `tran_amt` is the tag value where the configuration maps this tag to it.  A row
    with an amount goes before one without; ties go by tag, value and configured tag.

    Of the configuration rows of an event only two can win for a detail row: the first
    amount row of its tag, else the first row of all.  So each detail row meets one row
    per event code in each of two lookups, never all rows of its event.  `counted`, the
    detail rows before their deduplication, is read for events and tags that are on many
    rows; these are spread.
    """
    event = norm("evnt_cd").alias("_event")
    row = F.struct("tag_nm", "trgt_col_nm")
    # nulls sort first in a struct, as in the order of the result
    any_row = event_attr_config.groupBy("evnt_cd").agg(F.min(row).alias("_any"))
    amount_row = (
        event_attr_config.filter(norm("trgt_col_nm") == "tran_amt")
        .groupBy("evnt_cd", norm("tag_nm").alias("_tag"))
        .agg(F.min(row).alias("_amount"))
    )
    rows = dedup.select("uid", "log_dte", "tagname", "tagvalue", norm("acn_cat_nme").alias("_event"))
    if counted is not None:
        counted = counted.select(norm("acn_cat_nme").alias("_event"), norm("tagname").alias("_tag"))
    joined = spread_join(rows, any_row.select(event, "evnt_cd", "_any"), ["_event"], counted=counted)
    joined = spread_join(
        joined.withColumn("_tag", norm("tagname")), amount_row.select(event, "*"), ["_event", "evnt_cd", "_tag"],
        spread_by=["uid", "tagname", "tagvalue"], counted=counted, counted_by=["_event", "_tag"],
    )
    found = F.when(F.col("tagvalue").isNotNull(), F.col("_amount"))
    joined = joined.select(
        "uid", "log_dte", "tagname", "tagvalue", "evnt_cd",
        F.coalesce(found, F.col("_any")).alias("_row"),
        F.when(found.isNotNull(), F.col("tagvalue")).alias("tran_amt"),
    ).select("*", "_row.trgt_col_nm", "_row.tag_nm").drop("_row")
    ties = ("tagname", "tagvalue", "tag_nm", "log_dte", "trgt_col_nm")
    order = [F.col("tran_amt").isNull(), *[F.col(c).asc_nulls_first() for c in ties]]
    return first_row(joined, ["uid", "evnt_cd"], order).select(
        "uid", "log_dte", "tagname", "tagvalue", "evnt_cd", "trgt_col_nm", "tag_nm", "tran_amt"
    )
