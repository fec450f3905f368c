"""The key filter, hot keys found in the data, counts taken on the way, functions of SQL."""

from __future__ import annotations

import pytest
from helpers import bag, plan
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tagloom.functions import fields, sql, text
from tagloom.operators import customer, details, dimensions, journeys, key_filter
from tagloom.operators.joins import find_hot_keys, spread_join


# --- key filter --------------------------------------------------------------------


@pytest.mark.parametrize("expected", [0, 1, 50, 2000])
def test_the_filter_never_drops_a_partner(spark, expected):
    side = spark.range(0, 2000, 2).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("n"))
    facts = spark.range(4000).select(F.when(F.col("id") % 10 != 3, F.col("id").cast("string")).alias("k"), (F.col("id") % 7).alias("n"), "id")
    kept = key_filter.filtered(facts, side, ["k", "n"], expected)
    want = facts.join(side, ["k", "n"], "left_semi")
    assert bag(kept.join(side, ["k", "n"], "left_semi")) == bag(want)
    if expected == 2000:  # few others pass
        assert kept.count() <= want.count() * 1.1
    assert kept.where("k IS NULL").count() == 0


def test_a_filter_of_nothing_passes_nothing(spark):
    side = spark.createDataFrame([(None,)], "k string")
    assert key_filter.filtered(spark.range(5).select(F.col("id").cast("string").alias("k")), side, ["k"], 1).count() == 0


def test_filter_size_is_bounded():
    assert [key_filter.filter_bits(n) for n in (0, 1, 100, 10**12)] == [64, 64, 1024, key_filter.MOST_BITS]


def test_the_filter_stands_below_the_shuffle_and_lets_few_rows_through(spark, sf_dir, conf):
    conf(autoBroadcastJoinThreshold="-1")
    x = registry._Inputs(spark, sf_dir)
    few = x.tag_rows.where("lower(tag) = 'mmb_num'")
    rows = x.clean
    plain, less = details.tag_pairs(rows, few), details.tag_pairs(rows, few, expected_tags=10)
    assert bag(plain) == bag(less)
    lines = plan(less).splitlines()
    first = next(i for i, line in enumerate(lines) if "Filter" in line and "subquery#" in line)
    over = [line for line in lines[:first] if "Exchange hashpartitioning(_event" in line]
    assert over  # the shuffle of the join, with the filter and the scan under it
    moved = key_filter.filtered(rows.select(text.norm("tagname").alias("t")), few.select(text.norm("tag").alias("t")), ["t"], 10)
    assert 0 < moved.count() < 0.6 * rows.count()


def test_first_transaction_with_the_filter(spark, sf_dir):
    x = registry._Inputs(spark, sf_dir)
    order = ["log_dte", "seq"]
    plain = details.first_transaction(x.details, x.active_events, x.main, order)
    assert bag(plain) == bag(details.first_transaction(x.details, x.active_events, x.main, order, expected_tags=100))


def test_removed_journeys_shuffle_less(spark, sf_dir, conf):
    conf(autoBroadcastJoinThreshold="-1")
    x = registry._Inputs(spark, sf_dir)
    only = x.journey.where("journey_id % 10 IN (0, 8, 9) OR journey_id % 200 = 1")
    plain, less = journeys.validate_journeys(only)[1], journeys.removed_journeys(only, 100)
    assert bag(plain) == bag(less) and plain.count() > 0


# --- hot keys ----------------------------------------------------------------------


def skewed(spark, rows=40_000):
    hot = F.when(F.col("id") % 3 == 0, F.lit("77")).otherwise((F.col("id") % 5000).cast("string"))
    return spark.range(0, rows, 1, 8).select(hot.alias("mmb_num"), F.col("id").alias("uid"))


def test_hot_keys_are_found(spark):
    assert find_hot_keys(skewed(spark), "mmb_num") == ["77"]
    even = spark.range(10_000).select((F.col("id") % 5000).cast("string").alias("k"))
    assert find_hot_keys(even, "k") == []
    assert find_hot_keys(even.limit(0), "k") == []
    assert find_hot_keys(spark.range(9).select(F.lit(None).cast("string").alias("k")), "k") == []
    three = spark.range(9000).select(F.concat(F.lit("k"), F.col("id") % 3).alias("k"))
    assert sorted(find_hot_keys(three, "k", share=0.2)) == ["k0", "k1", "k2"]
    with pytest.raises(ValueError, match="share"):
        find_hot_keys(even, "k", share=0)


def test_an_undeclared_hot_key_is_spread(spark, conf):
    """No task of the join has twice the mean, with nothing but the sketch to help."""
    conf(
        adaptive__skewJoin__enabled="false", adaptive__coalescePartitions__enabled="false",
        autoBroadcastJoinThreshold="-1", shuffle__partitions="16",
    )
    facts = skewed(spark)
    lookup = spark.range(5000).select(F.col("id").cast("string").alias("mmb_num"), (F.col("id") * 2).alias("v"))

    def largest(hot):
        joined = spread_join(facts, lookup, ["mmb_num"], hot_keys=hot)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        return max(sizes) / (sum(sizes) / 16)

    assert largest([]) > 4
    assert largest(find_hot_keys(facts, "mmb_num")) < 2


def test_customer_ids_with_found_keys(spark, sf_dir):
    x = registry._Inputs(spark, sf_dir)
    main = x.main.withColumn("mmb_num", F.when(F.col("uid").cast("long") % 3 == 0, F.lit("7")).otherwise(F.col("mmb_num")))
    assert bag(customer.customer_id(main, x.latest_link, find_hot=True)) == bag(customer.customer_id(main, x.latest_link))


# --- counts taken on the way ----------------------------------------------------------


def jobs_of(spark, action):
    tracker, group = spark.sparkContext.statusTracker(), f"group-{id(action)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_journeys_are_counted_by_the_write(spark, sf_dir, tmp_path):
    x = registry._Inputs(spark, sf_dir)
    labelled = journeys.label_journeys(x.journey)
    counts = Observation()
    plain = jobs_of(spark, lambda: labelled.write.parquet(str(tmp_path / "plain")))
    observed = journeys.observe_journeys(labelled, counts)
    assert jobs_of(spark, lambda: observed.write.parquet(str(tmp_path / "seen"))) == plain
    kept, removed = journeys.validate_journeys(x.journey)
    got = counts.get
    assert got["kept"] == kept.count() and got["removed"] == removed.count()
    assert got["kept"] + got["removed"] == got["rows"] == x.journey.count()
    assert got["J1"] == removed.where(F.array_contains("reasons", "J1")).count() > 0


def test_unmatched_codes_are_counted_by_the_write(spark, sf_dir, tmp_path):
    x = registry._Inputs(spark, sf_dir)
    rows = fields.error_code(x.main).select("uid", "chnl_cd", F.trim("acn_cat_nme").alias("event_cd"), "err_cd")
    keyed = dimensions.dimension_keys_left(rows, x.chnl_map, x.event_map, x.err_map)
    counts = Observation()
    dimensions.observe_unmatched(keyed, counts).write.parquet(str(tmp_path / "keyed"))
    want = {"rows": keyed.count()}
    for key, code in dimensions.CODES.items():
        want[f"{key}_unmatched"] = keyed.where(F.col(code).isNotNull() & F.col(key).isNull()).count()
    assert counts.get == want and want["chnl_key_unmatched"] > 0
    some = Observation()
    dimensions.observe_unmatched(keyed.drop("err_key"), some).write.parquet(str(tmp_path / "some"))
    assert set(some.get) == {"rows", "chnl_key_unmatched", "event_key_unmatched"}


# --- functions of SQL ------------------------------------------------------------------

AWKWARD = [None, "", " ", "null", " NULL ", "none", " None ", "Paym ", "InstN paym", "abc.12.3", ".7", "x.y", "a1b2",
           "123456789012", "123456789012.5", "1234567890123.75", "12345678901234", "A-12 ", "999999999999", " 999999999999 ",
           'say "one" and "two"', 'x}}', "}}", '{"a": {}', "é\t", "v1.5", " E42", "a failure message far over the limit",
           fields.GROUP_PAYMENT.upper(), " /olb/fspay/mrp/payments.json "]


def test_functions_of_sql_equal_the_column_rules(spark):
    sql.register(spark)
    pairs = [(a, b) for a in AWKWARD for b in AWKWARD]
    df = spark.createDataFrame(pairs, "a string, b string")
    plain = df.select(
        text.norm("a"), text.is_blank("a"), text.is_present("a"), text.keep_chars("a"), text.mask_account("a"),
        text.clip_amount("a"), text.clip_amount("a", keep_exact_12=True), text.quote_before_braces("a"),
        text.extract_quoted("a", "plain"), text.extract_quoted_all("a"),
    )
    names = [f"c{i}" for i in range(10)]
    stated = df.selectExpr(
        "audit_norm(a)", "audit_is_blank(a)", "audit_is_present(a)", "audit_keep_chars(a, '[^0-9]')", "audit_mask_account(a)",
        "audit_clip_amount(a, false)", "audit_clip_amount(a, true)", "audit_quote_before_braces(a)",
        "audit_extract_quoted(a)", "audit_extract_quoted_all(a)",
    )
    assert bag(plain.toDF(*names)) == bag(stated.toDF(*names))


@pytest.mark.parametrize(
    "function,columns,out,rule",
    [
        ("normalise_tagname", ("acn_cat_nme", "tagname"), "tagname", fields.normalise_tagname),
        ("categorise_tag", ("acn_cat_nme", "tagname"), "tagname", fields.categorise_tag),
        ("tag_volume", ("acn_cat_nme", "tagname"), "vol", fields.tag_volume),
        ("member_id_placeholder", ("mmb_num", "mmb_num_t"), "mmb_num", fields.member_id_placeholder),
        ("member_id_prefer_detail", ("mmb_num", "mmb_num_t"), "cust_mbr_id", fields.member_id_prefer_detail),
        ("error_code", ("err_msg_txt", "stopflow_t"), "err_cd", fields.error_code),
        ("result_flag", ("err_msg_txt",), "result_flag", fields.result_flag),
        ("to_account_id", ("sortcode1_t", "sortcode2_t", "sortcode3_t", "to_acct_id"), "v_to_acct_id_t", fields.to_account_id),
        ("from_account_id", ("fr_acct_id", "prd_key", "src_idw_tp", "val"), "fr_acct_id", fields.from_account_id),
    ],
)
def test_functions_of_sql_equal_the_row_rules(spark, function, columns, out, rule):
    sql.register(spark)
    shift = lambda i, n: AWKWARD[(i * (2 * n + 1) + n) % len(AWKWARD)]
    rows = [(i, *[shift(i // len(AWKWARD) * n + i, n) for n in range(len(columns))]) for i in range(len(AWKWARD) ** 2)]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} string" for c in columns))
    want = rule(df).select("i", F.col(out).alias("out"))
    assert bag(want) == bag(df.selectExpr("i", f"audit_{function}({', '.join(columns)}) AS out"))


def test_registering_twice_and_under_another_prefix(spark):
    assert sql.register(spark) == sql.register(spark)
    names = sql.register(spark, "other_")
    assert len(names) == len(sql.FUNCTIONS) and spark.sql("SELECT other_norm(' A ')").first()[0] == "a"
    shown = {r.function for r in spark.sql("SHOW USER FUNCTIONS").collect()}
    assert {"audit_norm", "other_norm"} <= shown
