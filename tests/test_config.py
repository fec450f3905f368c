from __future__ import annotations

import pytest

from tagloom.operators import config

CHANNELS = "active int, chnl_cd string, chnl_key int"


def test_active_channel_key(spark):
    df = spark.createDataFrame([(1, "OLB", 101), (1, "MOB", 102), (0, "OLB", 999)], CHANNELS)
    assert [tuple(r) for r in config.active_channel_key(df).collect()] == [(101,)]
    assert [tuple(r) for r in config.active_channel_key(df, "MOB").collect()] == [(102,)]
    assert config.active_channel_key(df, "XXX").collect() == []


def test_two_active_channels_are_an_error(spark):
    df = spark.createDataFrame([(1, "OLB", 101), (1, "OLB", 102)], CHANNELS)
    with pytest.raises(Exception, match="several active channels"):
        config.active_channel_key(df).collect()


def test_same_channel_twice_is_one(spark):
    df = spark.createDataFrame([(1, "OLB", 101), (1, "OLB", 101)], CHANNELS)
    assert [tuple(r) for r in config.active_channel_key(df).collect()] == [(101,)]


def test_normalise_rules(spark):
    chnl = spark.createDataFrame([(101,)], "chnl_key int")
    schema = (
        "active int, chnl_key int, filter_col1 string, filter_condn1 string, filter_col2 string, "
        "filter_condn2 string, val_col string, new_trans_col string"
    )
    rows = [
        (1, 101, " A ", "X ", "B", None, "Val", " Out "),
        (0, 101, "a", "x", "b", "y", "v", "dead"),
        (1, 102, "a", "x", "b", "y", "v", "other"),
    ]
    out = config.normalise_rules(spark.createDataFrame(rows, schema), chnl).collect()
    assert [tuple(r) for r in out] == [("a", "x", "b", None, "Val", "out")]
    assert out[0].asDict().keys() == {
        "filter_col1", "filter_condn1", "filter_col2", "filter_condn2", "value_col", "new_col"
    }


def test_journey_tags(spark):
    chnl = spark.createDataFrame([(101,)], "chnl_key int")
    rows = [
        (1, 101, "P", "Tran_Amt, MMB ,tran_amt"), (1, 101, "P", " mmb,x"), (1, 101, "L", "y,"),
        (0, 101, "P", "dead"), (1, 102, "P", "other"), (1, 101, "N", None),
    ]
    df = spark.createDataFrame(rows, "active int, chnl_key int, evnt_cd string, cmpx_jrny_tag string")
    out = {r.evnt_cd: r.cmpx_jrny_tag_vec for r in config.journey_tags(df, chnl).collect()}
    assert out == {"P": ["mmb", "tran_amt", "x"], "L": ["y"]}
