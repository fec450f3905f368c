from __future__ import annotations

from datetime import date

import pytest
from helpers import bag, column, final_plan, plan
from pyspark.sql import functions as F

from tagloom.functions import fields
from tagloom.operators import details
from tagloom.plans.audit import wide_details

RULE = "filter_col1 string, filter_condn1 string, filter_col2 string, filter_condn2 string, value_col string, new_col string"
ROW = "uid string, log_dte date, seq int, acn_cat_nme string, tagname string, tagvalue string"
DAY = date(2024, 1, 1)


def rules_of(spark, *rows):
    return spark.createDataFrame(list(rows), RULE)


def rows_of(spark, *rows):
    return spark.createDataFrame([(u, DAY, *rest) for u, *rest in rows], ROW)


def test_clean_details(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, d), v) for d in (1, 2) for v in (None, "", "  ", " Null ", "x")],
        "uid string, log_dte date, tagvalue string",
    )
    assert details.clean_details(df).count() == 2
    assert column(details.clean_details(df, date(2024, 1, 2)), "log_dte") == [date(2024, 1, 2)]
    assert column(details.clean_details(df, "2024-01-02"), "log_dte") == [date(2024, 1, 2)]
    today = df.withColumn("log_dte", F.date_sub(F.current_date(), F.dayofmonth("log_dte") - 1))
    assert details.clean_details(today, F.current_date()).count() == 1


def test_dedup_is_defined_and_idempotent(spark, sf_dir):
    import __spark_entry__ as registry

    x = registry._Inputs(spark, sf_dir)
    once = details.dedup_details(x.clean, order_by=["seq"])
    want = bag(once)
    assert bag(details.dedup_details(once, order_by=["seq"])) == want
    shuffled = x.clean.repartition(7, F.xxhash64("tagvalue", "seq")).sortWithinPartitions(F.desc("ses_idr"))
    assert bag(details.dedup_details(shuffled, order_by=["seq"])) == want
    keys = once.select(*details.DEDUP_KEY)
    assert keys.distinct().count() == keys.count() == x.clean.select(*details.DEDUP_KEY).distinct().count()


def test_dedup_greatest_first_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "z"), ("a", 3, "y"), ("a", 3, None), (None, 1, "b"), (None, 1, "a"), ("c", None, "q"), ("c", 1, "r")],
        "k string, vol int, other string",
    )
    out = {r.k: (r.vol, r.other) for r in details.dedup_details(df, ["k"], greatest="vol").collect()}
    assert out == {"a": (3, None), None: (1, "a"), "c": (1, "r")}


def test_dedup_on_all_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert sorted(column(details.dedup_details(df, ["k"]), "k"), key=str) == [None, "a"]


def test_transpose(spark):
    df = rows_of(
        spark,
        ("u1", 1, "Paym ", "Tran_Amt", "5"), ("u1", 2, "paym", "tran_amt", "7"), ("u1", 3, "other", "tran_amt", "9"),
        ("u2", 1, "paym", "mmb", "m"), ("u3", 1, "x", "y", "z"),
    )
    rules = rules_of(
        spark,
        ("acn_cat_nme", "paym", "tagname", "tran_amt", "tagvalue", "amt"),
        ("acn_cat_nme", "paym", "tagname", "no_such", "tagvalue", "amt"),
        ("acn_cat_nme", "paym", "tagname", "mmb", " TagValue", "mmb"),
        ("acn_cat_nme", "paym", "tagname", "mmb", "seq", "seen"),
        ("acn_cat_nme", "paym", "tagname", None, "tagvalue", "never"),
        ("tagname", "y", "tagname", "z", "tagvalue", "contradiction"),
        ("tagname", "y", "tagname", "y", "tagvalue", "same"),
    )
    want = {
        "u1": ("7", None, None, None, None, None),
        "u2": (None, None, "m", None, None, "1"),
        "u3": (None, None, None, None, "z", None),
    }
    out = details.transpose_by_rules(df, rules)
    assert out.columns == ["uid", "amt", "contradiction", "mmb", "never", "same", "seen"]
    assert {r.uid: tuple(r)[1:] for r in out.collect()} == want


def test_two_rules_with_one_target_combine(spark):
    df = rows_of(spark, ("u", 1, "a", "t1", "1"), ("u", 2, "a", "t2", "2"), ("v", 1, "a", "t1", "9"))
    rules = rules_of(
        spark, ("acn_cat_nme", "a", "tagname", "t1", "tagvalue", "o"), ("acn_cat_nme", "a", "tagname", "t2", "tagvalue", "o")
    )
    out = details.transpose_by_rules(df, rules)
    assert {r.uid: r.o for r in out.collect()} == {"u": "2", "v": "9"}


def test_transpose_refuses_bad_rules(spark):
    df = rows_of(spark, ("u", 1, "a", "t", "1"))
    with pytest.raises(ValueError, match="names no column: nope"):
        details.transpose_by_rules(df, rules_of(spark, ("nope", "a", "tagname", "t", "tagvalue", "o")))
    with pytest.raises(ValueError, match="grouping or carried column"):
        details.transpose_by_rules(df, rules_of(spark, ("tagname", "a", "tagname", "t", "tagvalue", "uid")))


def test_transpose_without_rules(spark):
    df = rows_of(spark, ("u", 1, "a", "t", "1"), ("u", 2, "a", "t", "1"))
    assert column(details.transpose_by_rules(df, rules_of(spark)), "uid") == ["u"]


def read_plainly(rows, rules, columns):
    """uid to target to greatest value, by trying every rule on every row."""
    out = {}
    for row in rows:
        have = dict(zip(columns, row))
        found = out.setdefault(have["uid"], {})
        for c1, v1, c2, v2, value, target in rules:
            if str(have[c1]).strip().lower() == v1 and str(have[c2]).strip().lower() == v2:
                found[target] = max(found.get(target, ""), str(have[value]))
    return out


@pytest.mark.parametrize("tests", [("tagname", "tagvalue"), ("acn_cat_nme", "tagname")])
@pytest.mark.parametrize("n", [50, 400, 1500, 5000])
def test_any_number_of_rules(spark, tests, n):
    """Through the early cut, the deduplication and the transposition, as a plain reading."""
    values = {"tagname": lambda i: f"T{i}", "tagvalue": lambda i: f"V{i}", "acn_cat_nme": lambda i: f" Cat{i % 3}"}
    rows = [(f"u{i % 9}", i, values["acn_cat_nme"](i), values["tagname"](i), values["tagvalue"](i)) for i in range(0, 2 * n, 7)]
    norm = lambda v: v.strip().lower()
    rules = [(tests[0], norm(values[tests[0]](i)), tests[1], norm(values[tests[1]](i)), ("tagvalue", "seq")[i % 2], f"o{i % 300}") for i in range(n)]
    df, table = rows_of(spark, *rows), rules_of(spark, *rules)
    cut = details.dedup_details(details.cut_for_rules(df, table))
    out = details.transpose_by_rules(cut, table)
    want = read_plainly(rows, rules, ["uid", "seq", "acn_cat_nme", "tagname", "tagvalue"])
    got = {r.uid: {k: v for k, v in r.asDict().items() if k != "uid" and v is not None} for r in out.collect()}
    assert got == want
    assert sorted(out.columns[1:]) == sorted({r[5] for r in rules})


def test_an_unrelated_rule_changes_nothing_else(spark):
    """Which of two equal rows counts does not depend on the columns that rules read."""
    df = spark.createDataFrame(
        [("u", DAY, "paym", "mmb", "1", "1", "Z"), ("u", DAY, "paym", "mmb", "1", "2", "A"), ("u", DAY, "paym", "x", "9", "3", "B")],
        "uid string, log_dte date, acn_cat_nme string, tagname string, tagvalue string, mmb_num string, ses_idr string",
    )
    one = ("acn_cat_nme", "paym", "tagname", "mmb", "ses_idr", "prd_key")
    alone = wide_details(df, rules_of(spark, one)).collect()
    for other in (
        ("acn_cat_nme", "paym", "tagname", "no_such", "mmb_num", "other"),
        ("acn_cat_nme", "paym", "msg", "f", "mmb_num", "other"),
        ("tagname", "mmb", "tagvalue", "2", "mmb_num", "other"),
    ):
        rows = wide_details(df.withColumn("msg", F.lit("g")), rules_of(spark, one, other)).collect()
        assert [(r.prd_key, r.vol, r.other) for r in rows] == [(alone[0].prd_key, alone[0].vol, None)]
    assert alone[0].prd_key == "Z"  # by member before session


def test_days_of_a_request_stay_apart(spark):
    rules = rules_of(spark, ("acn_cat_nme", "paym", "tagname", "amt", "tagvalue", "tran_amt"))
    df = spark.createDataFrame(
        [("u", date(2024, 1, d), "paym", "amt", v) for d, v in ((1, "1"), (2, "9"))],
        "uid string, log_dte date, acn_cat_nme string, tagname string, tagvalue string",
    )
    whole = wide_details(df, rules)
    single = [wide_details(df, rules, date(2024, 1, d)) for d in (1, 2)]
    assert bag(whole) == bag(single[0].union(single[1]))
    assert sorted((r.log_dte.day, r.tran_amt) for r in whole.collect()) == [(1, "1"), (2, "9")]


@pytest.mark.parametrize(
    "rules",
    [
        [("acn_cat_nme", "paym", "tagname", "tran_amt", "tagvalue", "a"), ("acn_cat_nme", "paym", "tagname", "mmb_num", "ses_idr", "b")],
        [("acn_cat_nme", "paym", "msg_typ", "f", "tagvalue", "a")],
        [("tagname", "tran_amt", "tagname", "tran_amt", "tagvalue", "a"), ("tagname", "mmb_num", "tagvalue", "7", "log_millisec", "b")],
        [("acn_cat_nme", "paym", "tagname", None, "tagvalue", "a")],
        [("uid", "7", "log_dte", "2024-01-08", "tagvalue", "a")],
    ],
)
def test_early_cut_changes_nothing(spark, sf_dir, rules):
    """Nulling what no rule can use, before the deduplication, gives the same columns."""
    import __spark_entry__ as registry

    x = registry._Inputs(spark, sf_dir)
    table = rules_of(spark, *rules)
    cut = wide_details(x.details, table)
    rows = fields.normalise_tagname(fields.tag_volume(x.clean))
    whole = details.transpose_by_rules(
        details.dedup_details(rows, greatest="vol"), table, by=("uid", "log_dte"), carry=["vol"]
    )
    assert bag(cut) == bag(whole)
    # the volume is the greatest of all clean rows, merged or not
    volumes = rows.groupBy("uid").agg(F.max("vol").alias("vol"))
    assert bag(cut.select("uid", "vol")) == bag(volumes)


def test_group_details(spark):
    df = spark.createDataFrame([("u", "a", 1), ("u", "b", None), ("v", None, 3)], "uid string, x string, n int")
    assert {r.uid: (r.x, r.n) for r in details.group_details(df).collect()} == {"u": ("b", 1), "v": (None, 3)}


def tags_of(spark):
    return spark.createDataFrame([("PAYM", "mmb"), ("PAYM", "tran"), ("LOGIN", "y")], "evnt_cd string, tag string")


def test_tag_vector_matches_per_event(spark):
    df = rows_of(
        spark,
        ("u", 1, " paym", "Tran", "1"), ("u", 2, "paym", "mmb", "2"), ("u", 3, "paym", "mmb", "2"), ("u", 4, "paym", "y", "3"),
        ("u", 5, "login", "y", "4"), ("v", 1, "login", "mmb", "5"),
    )
    out = details.tag_vector(df, tags_of(spark), parts=1).collect()
    assert [(r.uid, r.part, [tuple(p) for p in r.tag_vec]) for r in out] == [("u", 0, [("Tran", "1"), ("mmb", "2"), ("y", "4")])]
    more = df.union(rows_of(spark, ("u", 6, "paym", "mmb", "11")))
    mapped = details.tag_map(more, tags_of(spark), parts=1).collect()
    assert [tuple(r) for r in mapped] == [("u", 0, {"Tran": "1", "mmb": "2", "y": "4"})]
    assert bag(details.tag_names(more, tags_of(spark))) == {("Tran", "u"): 1, ("mmb", "u"): 1, ("y", "u"): 1}


@pytest.mark.parametrize("uid", ["hot", None])
def test_every_request_is_dealt_to_the_same_parts(spark, uid):
    """The part is a function of the pair alone: size and neighbours of a request do not matter."""
    df = rows_of(spark, *[(uid, i, "paym", "mmb", f"v{i % 700}") for i in range(1000)], ("u", 1, "paym", "mmb", "v1"))
    out = details.tag_vector(df, tags_of(spark), parts=14).collect()
    hot = {r.part: [p.tagvalue for p in r.tag_vec] for r in out if r.uid == uid}
    assert set(hot) == set(range(14))
    values = [v for part in hot.values() for v in part]
    assert len(values) == 700 and set(values) == {f"v{i}" for i in range(700)}
    assert max(map(len, hot.values())) < 100
    ((part, vec),) = [(r.part, [p.tagvalue for p in r.tag_vec]) for r in out if r.uid == "u"]
    assert vec == ["v1"] and "v1" in hot[part]


def test_parts_are_the_callers_choice(spark):
    """The shape of a result stays as large requests come; the parts they need can be asked for."""
    small = rows_of(spark, ("u", 1, "paym", "mmb", "v1"))
    df = small.union(rows_of(spark, *[("hot", i, "paym", "mmb", f"v{i % 700}") for i in range(1000)]))
    assert details.parts_for(details.tag_pairs(df, tags_of(spark)), most=50) == 14
    assert details.parts_for(details.tag_pairs(df, tags_of(spark))) == 1
    assert details.parts_for(details.tag_pairs(df.limit(0), tags_of(spark))) == 1
    for parts in (3, 14):
        out = details.tag_vector(df, tags_of(spark), parts=parts).collect()
        hot = {r.part: [p.tagvalue for p in r.tag_vec] for r in out if r.uid == "hot"}
        assert set(hot) == set(range(parts)) and max(map(len, hot.values())) < 1400 / parts
        assert sorted(v for part in hot.values() for v in part) == sorted(f"v{i}" for i in range(700))
        alone = details.tag_vector(small, tags_of(spark), parts=parts)
        assert bag(alone) == {k: 1 for k in [next(iter(bag(alone)))]}
        assert [r for r in out if r.uid == "u"] == alone.collect()
    assert details.tag_vector(df.limit(0), tags_of(spark), parts=3).collect() == []


def test_tag_vector_reads_its_input_once(spark, sf_dir):
    import __spark_entry__ as registry

    x = registry._Inputs(spark, sf_dir)
    once = plan(details.tag_pairs(x.stripped, x.tag_rows)).count("FileScan")
    assert plan(details.tag_vector(x.stripped, x.tag_rows, parts=3)).count("FileScan") == once


@pytest.mark.parametrize("seed", range(3))
def test_compiled_and_joined_rules_agree(spark, monkeypatch, seed):
    """Rules on one, two and other columns, null and clashing conditions, shared targets."""
    import random

    rng = random.Random(seed)
    names, values = ["tagname", "acn_cat_nme", "mmb_num", "tagvalue"], ["a", "b", " C", "d ", None]
    rules = [
        (rng.choice(names), rng.choice(["a", "b", "c", "d", None]), rng.choice(names), rng.choice(["a", "b", "c", "d", None]), rng.choice(["tagvalue", "MMB_NUM "]), f"o{rng.randrange(9)}")
        for _ in range(40)
    ]
    kinds = "filter_col1 string, filter_condn1 string, filter_col2 string, filter_condn2 string, value_col string, new_col string"
    table = spark.createDataFrame(rules, kinds)
    rows = [(f"u{rng.randrange(40)}", rng.randrange(5), *[rng.choice(values) for _ in range(4)]) for _ in range(600)]
    df = spark.createDataFrame(rows, "uid string, vol int, tagname string, acn_cat_nme string, mmb_num string, tagvalue string")
    df = df.withColumn("log_dte", F.lit("2024-01-05").cast("date"))

    def result():
        cut = details.cut_for_rules(df, table, keep=["vol"])
        return bag(details.transpose_by_rules(details.dedup_details(cut, greatest="vol"), table, carry=["vol"]))

    compiled = result()
    assert "Join" not in plan(details.transpose_by_rules(df, table))
    monkeypatch.setattr(details, "COMPILED_RULES", 3)
    assert "Join" in plan(details.transpose_by_rules(df, table))
    assert result() == compiled and any(v is not None for row in compiled for v in row[1:4])


def config_of(spark, *rows):
    return spark.createDataFrame(list(rows), "evnt_cd string, trgt_col_nm string, tag_nm string")


def main_of(spark, *rows):
    return spark.createDataFrame(list(rows), "uid string, acn_cat_nme string")


def test_first_transaction(spark):
    df = rows_of(
        spark,
        ("u1", 2, "Paym ", "TRAN", "GBP 20.50"), ("u1", 1, "paym", "tran", "GBP 10.50"), ("u1", 0, "paym", "other", "1"),
        ("u2", 1, "paym", "tran", "  "), ("u2", 2, "paym", "tran", "30"),
        ("u3", 1, "paym", "tran", None), ("u3", 2, "paym", "tran", "40"),
        ("u4", 1, "paym", "tran", "none"), ("u5", 1, "login", "tran", "50"), ("u6", 1, "paym", "tran", "60"),
    )
    config = config_of(spark, ("PAYM", "Tran_Amt", "Tran"), (" paym", "tran_amt", " tran "), ("login", "other", "tran"))
    main = main_of(spark, *[(f"u{i}", "PAYM") for i in range(1, 6)], ("u1", "login"), ("u1", " paym "))
    out = details.first_transaction(df, config, main, order_by=["log_dte", "seq"])
    # u2 and u3: the first amount is blank, the later one does not count
    assert bag(out) == {("PAYM", "1050", "u1"): 1, (" paym ", "1050", "u1"): 1, ("PAYM", "", "u4"): 1}


def test_match_event_config(spark):
    df = rows_of(
        spark,
        ("u1", 1, "paym", "z", "1"), ("u1", 2, "Paym ", "TRAN", "7"), ("u1", 3, "paym", "tran", "6"), ("u2", 1, "paym", "b", "2"),
        ("u2", 2, "paym", "a", "3"), ("u3", 1, "none", "a", "4"),
    )
    config = config_of(spark, ("PAYM", "Tran_amt", "Tran"), ("PAYM", "mmb", "mmb"))
    out = details.match_event_config(details.dedup_details(df), config).collect()
    assert {(r.uid, r.evnt_cd, r.tagname, r.tran_amt, r.tag_nm) for r in out} == {
        ("u1", "PAYM", "TRAN", "7", "Tran"),
        ("u2", "PAYM", "a", None, "Tran"),
        ("u3", None, "a", None, None),
    }
    assert len(out) == 3


def test_event_rows_do_not_multiply(spark):
    """Many configuration rows of one event; the plain way joins them all."""
    df = rows_of(spark, *[(f"u{i % 50}", i, "paym", f"T{i % 40}", str(i)) for i in range(400)], ("x", 1, "paym", "T1", None))
    config = config_of(spark, *[("PAYM", ("tran_amt", "mmb")[i % 2], f"t{i}") for i in range(60)], ("PAYM", "Tran_Amt", "T4"), ("paym ", "mmb", None))
    got = details.match_event_config(df, config)
    joined = df.join(
        config, F.lower(F.trim("acn_cat_nme")) == F.lower(F.trim("evnt_cd")), "left"
    ).withColumn("tran_amt", F.expr("CASE WHEN lower(trim(trgt_col_nm)) = 'tran_amt' AND lower(trim(tag_nm)) = lower(trim(tagname)) THEN tagvalue END"))
    ties = ("tagname", "tagvalue", "tag_nm", "log_dte", "trgt_col_nm")
    order = [F.col("tran_amt").isNull(), *[F.col(c).asc_nulls_first() for c in ties]]
    assert bag(got) == bag(details.first_row(joined, ["uid", "evnt_cd"], order).select(*got.columns))
    # one row per event code ('PAYM' and 'paym ') is all that a detail row meets
    one_code = config.filter("evnt_cd = 'PAYM'")
    text = final_plan(details.match_event_config(df, one_code))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert one_code.groupBy("evnt_cd").count().count() == 1


def test_first_transaction_by_log_time(spark):
    df = spark.createDataFrame(
        [("u", DAY, "p", "t", v, "10:01", ms) for v, ms in (("1", "10"), ("2", "9"), ("3", "100"))]
        + [("u", DAY, "p", "t", "0", "10:02", "1")],
        "uid string, log_dte date, acn_cat_nme string, tagname string, tagvalue string, log_tme string, log_millisec string",
    )
    out = details.first_transaction(df, config_of(spark, ("p", "tran_amt", "t")), main_of(spark, ("u", "p")))
    assert column(out, "tran_amt_first") == ["2"]
