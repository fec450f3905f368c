from __future__ import annotations

from datetime import date

import pytest
from helpers import bag, column, final_plan
from pyspark.sql import functions as F

from tagloom.operators import customer, dimensions, requests

LINK = (
    "mmb_lnk_mmb_num string, cus_idr string, mmb_lnk_sts string, mmb_lnk_fls_type string, "
    "mmb_lnk_end_dte string, eff_start_date string, active string"
)


def test_normalise_main(spark):
    df = spark.createDataFrame(
        [(" 1 ", None, " None "), (None, " c ", None), ("", "d", " NULL"), ("2", "e", " E42 ")],
        "mmb_num string, cus_idr string, err_msg_txt string",
    )
    out = [(r.mmb_num, r.cus_idr, r.err_msg_txt) for r in requests.normalise_main(df).collect()]
    assert out == [("1", "-99", "none"), ("-99", "c", "none"), ("", "d", "none"), ("2", "e", "E42")]


def test_enrich_main_keeps_every_main_row(spark):
    main = spark.createDataFrame([("u1", "m"), ("u2", "n"), (None, "o"), (None, "o"), ("u1", "p")], "uid string, mmb_num string")
    wide = spark.createDataFrame([("u1", "d", 3), ("u9", "e", 4), (None, "f", 5)], "uid string, mmb_num string, vol int")
    out = requests.enrich_main(wide, main)
    assert out.columns == ["uid", "mmb_num", "mmb_num_t", "vol"]
    assert bag(out) == {
        ("m", "d", "u1", 3): 1, ("p", "d", "u1", 3): 1, ("n", None, "u2", None): 1, ("o", None, None, None): 2
    }


def test_enrich_main_refuses_clashing_names(spark):
    main = spark.createDataFrame([("u", "m", "x")], "uid string, a string, a_t string")
    with pytest.raises(ValueError, match="already there: a_t"):
        requests.enrich_main(spark.createDataFrame([("u", "d")], "uid string, a string"), main)


def test_latest_partition(spark, tmp_path):
    days = [date(2024, 1, d) for d in (1, 3, 2)]
    df = spark.createDataFrame([(f"u{i}", d) for i, d in enumerate(days * 2)], "uid string, log_dte date")
    assert set(column(requests.latest_partition(df), "log_dte")) == {date(2024, 1, 3)}
    other = spark.createDataFrame([("x", date(2024, 1, 2))], "uid string, log_dte date")
    assert set(column(requests.latest_partition(df, other), "log_dte")) == {date(2024, 1, 2)}
    path = str(tmp_path / "days")
    df.write.partitionBy("log_dte").parquet(path)
    stored = requests.latest_partition(spark.read.parquet(path))
    assert stored.count() == 2
    # the newest day prunes partitions before the scan
    assert "PartitionFilters: [isnotnull(log_dte" in final_plan(stored)


def test_active_customer_link(spark):
    rows = [
        ("1", "c3", " ac", "01", None, "2020-01-01", "1"), ("1", "c2", "AC", "02", " ", "2024-01-01", "1"),
        ("2", "c5", "AC", "02", "", "2020-01-01", "1"), ("2", "c4", "AC", "03", None, "2021-01-01", "1"),
        ("3", "c9", "AC", "01", None, "2021-01-01", "1"), ("3", "c8", "AC", "01", None, "2021-01-01", "1"),
        ("4", "c1", "CL", "01", None, "2021-01-01", "1"), ("5", "c1", "AC", "01", "2022-01-01", "2021-01-01", "1"),
        (None, "c1", "AC", "01", None, "2021-01-01", "1"),
    ]
    out = customer.active_customer_link(spark.createDataFrame(rows, LINK)).collect()
    assert {r.mmb_lnk_mmb_num: (r.cus_idr, r.priority) for r in out} == {"1": ("c3", "P"), "2": ("c4", "B"), "3": ("c8", "P")}
    assert len(out) == 3


def test_latest_customer_link(spark):
    rows = [
        ("1", "c1", "AC", "01", None, "2020-01-01", "1"), ("1", "c2", "AC", "01", None, "2022-01-01", "1"),
        ("1", None, "AC", "01", None, "2023-01-01", "1"), ("1", "c3", "AC", "01", None, "2024-01-01", "0"),
        ("2", "c7", "AC", "01", None, "2020-01-01", "1"), ("2", "c6", "AC", "01", None, "2020-01-01", "1"),
        ("3", "c8", "CL", "01", None, "2020-01-01", "1"),
    ]
    out = customer.latest_customer_link(spark.createDataFrame(rows, LINK)).collect()
    assert sorted(tuple(r) for r in out) == [("1", "c2"), ("2", "c6")]


def test_customer_id(spark):
    main = spark.createDataFrame(
        [("u1", " 1 ", "x"), ("u2", "2", "y"), ("u3", None, "z"), ("u4", "-99", "z"), ("u5", "999999999999", "z"), ("u6", "8", "z")],
        "uid string, mmb_num string, cus_idr string",
    )
    link = spark.createDataFrame(
        [("1", " 77 "), ("2", "abc"), ("999999999999", "55"), ("3", "1")], "mmb_lnk_mmb_num string, cus_idr string"
    )
    out = {r.uid: (r.cus_idr, r.cust_id, r.main_cus_idr) for r in customer.customer_id(main, link).collect()}
    assert out == {
        "u1": ("77", 77, "x"), "u2": ("abc", -99, "y"), "u3": ("-99", -99, "z"), "u4": ("-99", -99, "z"),
        # a placeholder that does have a link is looked up like any other member
        "u5": ("55", 55, "z"), "u6": ("-99", -99, "z"),
    }


def test_members_are_trimmed_on_both_sides(spark):
    main = spark.createDataFrame([("u1", " 1 "), ("u2", "1")], "uid string, mmb_num string")
    rows = [(" 1 ", "55", "2020-01-01"), ("1", "66", "2021-01-01"), ("1 ", "77", "2019-01-01")]
    links = spark.createDataFrame(
        [(m, c, "AC", "01", None, start, "1") for m, c, start in rows],
        "mmb_lnk_mmb_num string, cus_idr string, mmb_lnk_sts string, mmb_lnk_fls_type string, mmb_lnk_end_dte string, eff_start_date string, active string",
    )
    for link in (customer.active_customer_link(links), customer.latest_customer_link(links)):
        assert [(r.mmb_lnk_mmb_num, r.cus_idr) for r in link.collect()] == [("1", "66")]
        assert {r.uid: r.cust_id for r in customer.customer_id(main, link).collect()} == {"u1": 66, "u2": 66}


def test_row_count_is_kept_and_links_are_unique(spark, sf_dir):
    import __spark_entry__ as registry

    x = registry._Inputs(spark, sf_dir)
    main = x.main.count()
    for link in (customer.active_customer_link(x.custlink), x.latest_link):
        assert link.count() == link.select("mmb_lnk_mmb_num").distinct().count()
        assert customer.customer_id(x.main, link).count() == main
    flow = registry.queries()["audit_flow"](spark, sf_dir)
    assert flow.count() == main == flow.select("uid").distinct().count()
    days = flow.groupBy("log_dte").count().collect()
    one = next(d for d in days if d["count"])
    from tagloom.plans.audit import audit_flow

    day = audit_flow(
        x.details, x.main, x.custlink, x.chnl_map, x.rules, x.event_map, x.err_map, business_date=one.log_dte
    )
    assert bag(day) == bag(flow.filter(F.col("log_dte") == one.log_dte))


def test_dimension_keys(spark):
    chnl = spark.createDataFrame([(1, "OLB", 1), (0, "OLB", 9)], "active int, chnl_cd string, chnl_key int")
    event = spark.createDataFrame([(1, "paym", 10), (0, "paym", 99)], "active int, event_cd string, event_key int")
    err = spark.createDataFrame([("E", 5)], "err_cd string, err_key int")
    df = spark.createDataFrame(
        [("OLB", "paym", "E"), ("OLB", "login", None), ("X", "paym", "F")], "chnl_cd string, event_cd string, err_cd string"
    )
    out = dimensions.dimension_keys_left(df, chnl, event, err)
    assert bag(out.select("chnl_key", "event_key", "err_key")) == {(1, 5, 10): 1, (1, None, None): 1, (None, None, 10): 1}
    inner = dimensions.dimension_keys_inner(df.withColumnRenamed("event_cd", "evnt_cd"), chnl, event, err)
    assert bag(inner) == {(1, 5, 10): 1}


def test_two_keys_of_one_code_are_an_error(spark):
    event = spark.createDataFrame([(1, "paym", 10), (1, "paym", 11), (1, "login", 5), (1, "login", 5)], "active int, event_cd string, event_key int")
    df = spark.createDataFrame([("login",), ("login",), ("x",)], "event_cd string")
    one = event.filter("event_cd = 'login'")
    assert bag(dimensions.dimension_keys_left(df, None, one)) == {("login", 5): 2, ("x", None): 1}
    with pytest.raises(Exception, match="several values of event_key for event_cd paym"):
        dimensions.dimension_keys_left(df, None, event).collect()


def flow_tables(spark, rules, details, main):
    from tagloom.schemas import SCHEMAS

    def table(entity, *rows):
        return spark.createDataFrame(list(rows), SCHEMAS[entity])

    return (
        table("audit_details", *[(u, d, c, t, v, None, None, None, None, None, None) for u, d, c, t, v in details]),
        table("audit_main", *main), table("cust_link"), table("chnl_map", (1, "OLB", 5)),
        table("rule_config", *[(1, 5, "acn_cat_nme", "paym", "tagname", t, "tagvalue", c) for t, c in rules.items()]),
        table("event_map", (1, "paym", 10)), table("err_map", ("E7", 70), ("E42", 42)),
    )


def test_error_text_is_chosen_per_row(spark):
    """The detail's text where there is one, else the main row's; code and flag read the same text."""
    from tagloom.plans.audit import audit_flow

    day = date(2024, 1, 1)
    main = [(u, day, None, None, e, "paym") for u, e in (("u1", "E42"), ("u2", "none"), ("u3", "none"), ("u4", "E42"))]
    details = [("u2", day, "paym", "error", " E7 "), ("u3", day, "paym", "x", "y"), ("u4", day, "paym", "error", "none")]
    want = {"u1": ("E42", 42, "Failure"), "u2": ("E7", 70, "Failure"), "u3": (None, None, "Success"), "u4": (None, None, "Success")}
    out = audit_flow(*flow_tables(spark, {"error": "err_msg_txt"}, details, main)).collect()
    assert {r.uid: (r.err_cd, r.err_key, r.result_flag) for r in out} == want
    # without the rule every row has the text of its main row
    out = audit_flow(*flow_tables(spark, {"x": "val"}, details, main)).collect()
    assert {r.uid: r.err_cd for r in out} == {"u1": "E42", "u2": None, "u3": None, "u4": "E42"}


def test_all_days_together_are_the_single_days(spark):
    from tagloom.plans.audit import audit_flow

    days = [date(2024, 1, d) for d in (1, 2)]
    details = [("u", days[0], "paym", "amt", "1"), ("u", days[1], "paym", "amt", "9"), ("v", days[1], "paym", "amt", "5")]
    main = [(u, d, "7", None, None, "paym") for u in ("u", "v") for d in days]
    tables = flow_tables(spark, {"amt": "tran_amt"}, details, main)
    whole = audit_flow(*tables)
    single = [audit_flow(*tables, business_date=d) for d in days]
    assert bag(whole) == bag(single[0]) + bag(single[1])
    assert {(r.uid, r.log_dte.day): r.tran_amt for r in whole.collect()} == {("u", 1): "1", ("u", 2): "9", ("v", 1): None, ("v", 2): "5"}


def test_mapping_flow_keeps_every_main_row(spark):
    from tagloom.plans.audit import mapping_flow
    from tagloom.schemas import SCHEMAS

    _, main, _, chnl, _, events, errors = flow_tables(spark, {}, [], [("u1", date(2024, 1, 1), " 1", None, "none", "x"), ("u2", date(2024, 1, 1), "2", None, None, "x")])
    link = spark.createDataFrame([("1 ", "77", "AC", "01", None, "2020-01-01", "1")], SCHEMAS["cust_link"])
    codes = spark.createDataFrame(
        [("u1", "OLB", "paym", "E7"), ("u1", "OLB", "zz", "E42"), ("u9", "OLB", "paym", "E7")], "uid string, chnl_cd string, evnt_cd string, err_cd string"
    )
    out = {r.uid: r for r in mapping_flow(main, link, codes, chnl, events, errors).collect()}
    assert {u: (r.cust_id, r.chnl_key, r.event_key, r.err_key, r.err_msg_txt) for u, r in out.items()} == {
        "u1": (77, 5, 10, 70, "Success"), "u2": (-99, None, None, None, "Failure"),
    }


def test_flow_on_a_few_rows(spark):
    """All steps on rows made by hand, with sort codes and error text among the tags."""
    from tagloom.plans.audit import audit_flow
    from tagloom.schemas import SCHEMAS

    def table(entity, *rows):
        return spark.createDataFrame(list(rows), SCHEMAS[entity])

    day = date(2024, 1, 1)
    group = "/olb/bulkpay/grouppaymentstepfour.json"
    tags = {
        "u1": [
            ("paym", "sc1", " 20"), ("paym", "sc2", "30"), ("paym", "sc3", "40"), ("paym", "from", "A-12345678901234"),
            ("paym", "member", " 7 "), ("paym", "amount", "1234567890123.5"), (group, "payee.3", "x"), (group, "payee.12", "x"),
        ],
        "u2": [("paym", "to", "98765432109876"), ("paym", "error", " E7 "), ("paym", "stop", "S9")],
        "u3": [("paym", "error", "null"), ("paym", "stop", " S9 "), ("paym", "member", "8")],
    }
    details = table(
        "audit_details",
        *[(u, day, c, t, v, None, None, None, None, None, None) for u, rows in tags.items() for c, t, v in rows],
    )
    targets = {
        "sc1": "sortcode1_t", "sc2": "sortcode2_t", "sc3": "sortcode3_t", "from": "fr_acct_id", "to": "to_acct_id",
        "member": "mmb_num", "amount": "tran_amt", "error": "err_msg_txt", "stop": "stopflow_t",
    }
    rules = table(
        "rule_config", *[(1, 5, "acn_cat_nme", "paym", "tagname", t, "tagvalue", c) for t, c in targets.items()]
    )
    main = table(
        "audit_main",
        ("u1", day, "999999999999", "old", None, " paym "),
        ("u2", day, "9", None, "main error", "login"),
        ("u3", day, "9", None, "main error", "paym"),
        ("u4", day, None, None, " none ", "paym"),
    )
    link = table("cust_link", ("7", "77", "AC", "01", None, "2020-01-01", "1"), ("9", "99", "AC", "01", None, "2020-01-01", "1"))
    chnl = table("chnl_map", (1, "OLB", 5))
    events = table("event_map", (1, "paym", 10))
    errors = table("err_map", ("E7", 70), ("S9", 90))
    out = {r.uid: r for r in audit_flow(details, main, link, chnl, rules, events, errors).collect()}

    assert out.keys() == {"u1", "u2", "u3", "u4"}
    one = out["u1"]
    assert (one.v_to_acct_id_t, one.fr_acct_id, one.tran_amt, one.vol) == ("203040", "123456|8901234", "123456789012", 12)
    assert (one.mmb_num, one.cus_idr, one.cust_id, one.main_cus_idr) == ("7", "77", 77, "old")
    assert (one.chnl_cd, one.chnl_key, one.event_id, one.event_cd, one.event_key) == ("OLB", 5, "10001028", "paym", 10)
    assert (one.err_cd, one.err_key, one.result_flag) == (None, None, "Success")
    two = out["u2"]
    assert (two.v_to_acct_id_t, two.cust_id, two.err_cd, two.err_key, two.event_key) == ("987654|2109876", 99, "E7", 70, None)
    assert two.result_flag == "Failure"
    # the word null is no tag value, so the main row's text is the code; member 8 does not replace a real one
    three = out["u3"]
    assert (three.err_cd, three.err_key, three.mmb_num, three.cust_id) == ("main error", None, "9", 99)
    four = out["u4"]
    assert (four.mmb_num, four.cust_id, four.vol, four.err_cd, four.result_flag) == ("-99", -99, None, None, "Success")
