"""Every registered query against its SQL in an independent engine, and its plan."""

from __future__ import annotations

import pytest
from helpers import plan

import __spark_entry__ as registry
from checks.compare import compare, connect

QUERIES = registry.core_queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql_and_stays_in_the_engine(spark, duck, sf_dir, name):
    """Same values; no Python worker, no cross or nested loop join, no limit in the plan."""
    df = QUERIES[name](spark, sf_dir)
    assert compare(df, duck, name) == ""
    text = plan(df).replace("WindowGroupLimit", "")
    for node in ("Python", "Arrow", "BroadcastNestedLoopJoin", "CartesianProduct", "Limit "):
        assert node not in text, node


def test_entry_is_the_whole_flow(spark):
    out = registry.entry(spark)
    assert out.count() > 0
    assert "cust_id" in out.columns


def test_dimensions_are_broadcast_by_size_only(spark, sf_dir, conf):
    query = QUERIES["dimension_keys_left"]
    assert plan(query(spark, sf_dir)).count("BroadcastHashJoin") == 3
    conf(autoBroadcastJoinThreshold="-1")
    text = plan(query(spark, sf_dir))
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 3


def test_top_row_is_cut_before_the_shuffle(spark, sf_dir):
    for name in ("customer_link_active", "customer_link_latest", "details_dedup", "first_transaction", "event_config_match"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "row_number(), 1, Partial" in text, name


def test_scans_read_only_what_they_need(spark, sf_dir):
    assert "ReadSchema: struct<c_custkey:bigint>" in plan(QUERIES["customer_link_latest"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(QUERIES["amount_clipped"](spark, sf_dir))


def test_date_and_null_filters_reach_the_scan(spark, sf_dir, tmp_path):
    from tagloom.operators.details import clean_details

    x = registry._Inputs(spark, sf_dir)
    path = str(tmp_path / "details")
    x.details.write.partitionBy("log_dte").parquet(path)
    text = plan(clean_details(spark.read.parquet(path), "2024-01-05"))
    assert "PartitionFilters: [isnotnull(log_dte" in text and "2024-01-05" in text
    assert "PushedFilters: [IsNotNull(tagvalue)]" in text


def test_journeys_are_grouped_once(spark, sf_dir):
    for name in ("journeys_kept", "journeys_removed", "journeys_labelled"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert text.count("LeftOuter") + text.count("Inner") == 1, name
        assert text.count("FileScan") == 2, name  # once for the flags, once for the rows
