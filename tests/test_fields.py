from __future__ import annotations

from helpers import column

from tagloom.functions import fields

GROUP = " /olb/bulkpay/GroupPaymentStepFour.json "


def test_tag_volume_before_strip(spark):
    rows = [
        (GROUP, "amount.12", 12), (GROUP, " amount.3 ", 3), (GROUP, "amount", 1), (GROUP, "amount.x", 1),
        (GROUP, "a.2.9", 2), (GROUP, "amount.", 1), (GROUP, "amount.99999999999", 1), ("paym", "amount.12", 1),
        (None, "amount.12", 1), (GROUP, None, 1),
    ]
    df = spark.createDataFrame(rows, "acn_cat_nme string, tagname string, want int")
    out = fields.tag_volume(df).collect()
    assert [r.vol for r in out] == [r.want for r in out]
    # stripping first would lose the number
    assert set(column(fields.tag_volume(fields.normalise_tagname(df)), "vol")) == {1}


def test_volumes_compare_as_numbers(spark):
    df = spark.createDataFrame([(GROUP, "a.9"), (GROUP, "a.10")], "acn_cat_nme string, tagname string")
    assert fields.tag_volume(df).agg({"vol": "max"}).first()[0] == 10


def test_normalise_tagname(spark):
    rows = [
        (GROUP, " amount.12", "amount"), (GROUP, "line2.3", "line2"), ("/olb/fspay/mrp/payments.json", "x.1.2", "x"),
        ("/olb/fxpay/mrp/payments.json", "x.1", "x.1"), ("paym", " x.1 ", " x.1 "), (None, "x.1", "x.1"),
    ]
    df = spark.createDataFrame(rows, "acn_cat_nme string, tagname string, want string")
    out = fields.normalise_tagname(df).collect()
    assert [r.tagname for r in out] == [r.want for r in out]


def test_normalise_tagname_other_rules(spark):
    df = spark.createDataFrame([("/OLB/fxpay/mrp/payments.json", "ab_1.2")], "acn_cat_nme string, tagname string")
    listed = ["/olb/fxpay/mrp/payments.json"]
    for pattern, replacement, want in [("[0-9]", "", "ab_."), ("[_0-9]", "*", "ab**.*"), ("[_0-9]", "", "ab.")]:
        assert column(fields.normalise_tagname(df, listed, pattern, replacement), "tagname") == [want]


def test_categorise_tag(spark):
    rows = [
        ("Instn paym", "t1", "/olb/ku/pay/grouppaymentsstepfour.json"),
        (" PAYMENT ", "t1", "/olb/ku/pay/payments.json"),
        ("login", "t1_2x", "t_x"),
        (None, "t1", "t"),
        ("login", None, None),
    ]
    df = spark.createDataFrame(rows, "acn_cat_nme string, tagname string, want string")
    out = fields.categorise_tag(df).collect()
    assert [r.tagname for r in out] == [r.want for r in out]


def test_account_ids(spark):
    rows = [
        # sort codes, to account -> to; from, product, source, value -> from
        (" 20", "30 ", "40", "T", "20" + "30" + "40", "A-12", "P3", "S4", "v5.6", "12"),
        (None, "30", "40", "T", "T", "abc", "P3", "S4", "v5.6", "3"),
        ("20", "30", None, None, None, None, " ", "S4", "v5.6", "4"),
        ("20", None, "40", "T", "T", "", "x", None, "v5.6", "5.6"),
        ("", "30", "40", "T", "3040", None, None, None, "v", None),
    ]
    schema = (
        "sortcode1_t string, sortcode2_t string, sortcode3_t string, to_acct_id string, want_to string, "
        "fr_acct_id string, prd_key string, src_idw_tp string, val string, want_from string"
    )
    df = spark.createDataFrame(rows, schema)
    out = fields.from_account_id(fields.to_account_id(df)).collect()
    assert [r.v_to_acct_id_t for r in out] == [r.want_to for r in out]
    assert [r.fr_acct_id for r in out] == [r.want_from for r in out]
    literal = column(fields.from_account_id(df, blank_as_null=False), "fr_acct_id")
    assert literal == ["12", "", "", "", ""]


def test_member_ids(spark):
    rows = [
        # main, detail -> by placeholder, by preferring the detail
        (" 999999999999 ", " 7 ", "7", "999999999999"),
        ("999999999999", "  ", "999999999999", "999999999999"),
        ("999999999999", None, "999999999999", "999999999999"),
        ("12", " 7", "12", "7"),
        (" 12 ", None, " 12 ", "12"),
        (None, "7", None, "-99"),
        (None, None, None, "-99"),
    ]
    df = spark.createDataFrame(rows, "mmb_num string, mmb_num_t string, p string, d string")
    by_placeholder = fields.member_id_placeholder(df).collect()
    assert [r.mmb_num for r in by_placeholder] == [r.p for r in by_placeholder]
    preferred = fields.member_id_prefer_detail(df).collect()
    assert [r.cust_mbr_id for r in preferred] == [r.d for r in preferred]


def test_error_code_and_result(spark):
    rows = [
        # text, stop flow -> code, result
        (" E42 ", " S1 ", "E42", "Failure"),
        ("none", " S1 ", "S1", "Success"),
        (" None ", None, None, "Failure"),
        (None, "S1", "S1", "Failure"),
        (None, None, None, "Failure"),
        ("null", "S1", "null", "Success"),
        ("NULL", None, "NULL", "Failure"),
        ("a text of over twenty letters", "S1", None, "Failure"),
        ("x" * 19, None, "x" * 19, "Failure"),
        ("x" * 20, None, None, "Failure"),
        ("", "S1", "", "Failure"),
    ]
    df = spark.createDataFrame(rows, "err_msg_txt string, stopflow_t string, c string, r string")
    out = fields.result_flag(fields.error_code(df)).collect()
    assert [r.err_cd for r in out] == [r.c for r in out]
    assert [r.result_flag for r in out] == [r.r for r in out]


def test_event_constants(spark):
    out = fields.event_constants(spark.createDataFrame([(" paym ",)], "acn_cat_nme string")).first()
    assert (out.event_id, out.chnl_cd, out.event_cd) == ("10001028", "OLB", "paym")
