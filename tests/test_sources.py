from __future__ import annotations

from datetime import date

import pytest
from helpers import bag, column
from pyspark.sql import functions as F

from tagloom.schemas import SCHEMAS, conform
from tagloom.sources import tables


def test_csv_by_header(spark, tmp_path):
    path = tmp_path / "chnl_map.csv"
    path.write_text("chnl_key,active,chnl_cd,note\n101,1,OLB,x\n102,bad,MOB,\n")
    raw = tables.read_csv(spark, str(path))
    assert raw.dtypes == [("chnl_key", "string"), ("active", "string"), ("chnl_cd", "string"), ("note", "string")]
    typed = tables.read_csv(spark, str(path), "chnl_map", null_bad=True)
    assert typed.dtypes == [("active", "int"), ("chnl_cd", "string"), ("chnl_key", "int"), ("note", "string")]
    assert [tuple(r) for r in typed.collect()] == [(1, "OLB", 101, "x"), (None, "MOB", 102, None)]


def test_values_that_do_not_fit_end_the_query(spark):
    main = spark.createDataFrame(
        [("u", "05/01/2024", None, None, None, None)],
        "uid string, log_dte string, mmb_num string, cus_idr string, err_msg_txt string, acn_cat_nme string",
    )
    for null_bad in (False, True):  # a date is never made null
        with pytest.raises(Exception, match="audit_main.log_dte: not a date: 05/01/2024"):
            conform(main, "audit_main", null_bad).collect()
    channel = spark.createDataFrame([("x", "OLB", "1")], "active string, chnl_cd string, chnl_key string")
    with pytest.raises(Exception, match="chnl_map.active: not a int: x"):
        conform(channel, "chnl_map").collect()
    assert [tuple(r) for r in conform(channel, "chnl_map", null_bad=True).collect()] == [(None, "OLB", 1)]
    good = main.withColumn("log_dte", F.lit("2024-01-05"))
    assert conform(good, "audit_main").first().log_dte == date(2024, 1, 5)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="chnl_map: missing columns chnl_cd, chnl_key"):
        conform(spark.createDataFrame([(1,)], "active int"), "chnl_map")


def test_conform_leaves_matching_columns_alone(spark):
    df = spark.createDataFrame([], SCHEMAS["audit_main"])
    assert conform(df, "audit_main").schema == SCHEMAS["audit_main"]


def test_write_table_and_read_back(spark):
    df = spark.createDataFrame(
        [(f"u{i}", date(2024, 1, 1 + i % 3)) for i in range(90)], "uid string, log_dte date"
    )
    tables.write_table(df, "written")
    stored = tables.read_table(spark, "written")
    assert bag(stored) == bag(df)
    assert [r.partition for r in spark.sql("SHOW PARTITIONS written").collect()] == [
        f"log_dte=2024-01-0{d}" for d in (1, 2, 3)
    ]
    spark.sql("DROP TABLE written")


@pytest.mark.parametrize("rebalance", [True, False])
def test_a_day_replaces_only_itself(spark, rebalance):
    def day(d, *values):
        return spark.createDataFrame([(f"u{v}", v, date(2024, 1, d)) for v in values], "uid string, n int, log_dte date")

    write = lambda df, **more: tables.write_table(df, "daily", rebalance=rebalance, **more)
    write(day(1, 1, 2))
    write(day(2, 3))
    assert bag(spark.table("daily")) == bag(day(1, 1, 2).union(day(2, 3)))
    write(day(1, 7))  # the first day again
    assert bag(spark.table("daily")) == bag(day(1, 7).union(day(2, 3)))
    write(day(3, 9).select("log_dte", "n", "uid"))  # columns go by name
    assert bag(spark.table("daily")) == bag(day(1, 7).union(day(2, 3)).union(day(3, 9)))
    with pytest.raises(ValueError, match="columns differ"):
        write(day(3, 9).drop("n"))
    write(day(4, 5), replace_all=True)
    assert bag(spark.table("daily")) == bag(day(4, 5))
    spark.sql("DROP TABLE daily")


def test_write_table_to_a_path(spark, tmp_path):
    df = spark.range(5).toDF("n")
    path = str(tmp_path / "out")
    tables.write_table(df, "placed", partition_by=None, path=path)
    assert sorted(column(tables.read_parquet(spark, path), "n")) == list(range(5))
    spark.sql("DROP TABLE placed")


def test_write_table_splits_a_large_day(spark, conf, tmp_path):
    """A day that is too large for one task is written by several, a small one by one."""
    conf(adaptive__advisoryPartitionSizeInBytes="64KB")
    n = F.col("id")
    df = spark.range(0, 20_000, 1, 8).select(
        F.sha2(n.cast("string"), 256).alias("uid"),
        F.when(n % 100 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("date").alias("log_dte"),
    )
    for rebalance in (True, False):
        path = tmp_path / f"days_{rebalance}"
        tables.write_table(df, "days", path=str(path), rebalance=rebalance)
        files = {d.name: len(list(d.glob("*.parquet"))) for d in path.iterdir() if d.is_dir()}
        assert files["log_dte=2024-01-01"] >= 8
        assert files["log_dte=2024-01-02"] == (1 if rebalance else 8)
        assert spark.table("days").count() == 20_000
        spark.sql("DROP TABLE days")


def test_read_parquet_checks_schema(spark, tmp_path):
    path = str(tmp_path / "err")
    spark.createDataFrame([("E", "5")], "err_cd string, err_key string").write.parquet(path)
    assert tables.read_parquet(spark, path, "err_map").dtypes == [("err_cd", "string"), ("err_key", "int")]


def test_flow_from_table_to_table(spark, sf_dir):
    """The whole flow over catalog tables with the declared schemas and no other columns."""
    import __spark_entry__ as registry
    from tagloom import audit_flow

    x = registry._Inputs(spark, sf_dir)
    views = {
        "audit_details": x.details, "audit_main": x.main, "cust_link": x.custlink, "chnl_map": x.chnl_map,
        "rule_config": x.rules, "event_map": x.event_map, "err_map": x.err_map,
    }
    for entity, df in views.items():
        only = [f.name for f in SCHEMAS[entity]]
        by = "log_dte" if "log_dte" in only else None
        tables.write_table(conform(df, entity).select(*only), f"in_{entity}", by)
    inputs = {e: tables.read_table(spark, f"in_{e}", e) for e in views}
    flow = audit_flow(**inputs)
    tables.write_table(flow, "audit_requests")
    stored = tables.read_table(spark, "audit_requests")
    assert stored.count() == x.main.count() > 0
    assert set(stored.columns) == set(flow.columns)
    assert bag(stored.select(*flow.columns)) == bag(flow)
    # nothing but the stop-flow text is missing against the flow over the wider views
    wide = registry.queries()["audit_flow"](spark, sf_dir)
    same = [c for c in wide.columns if c not in ("stopflow_t", "err_cd", "err_key")]
    assert bag(stored.select(*same)) == bag(wide.select(*same))
    for entity in views:
        spark.sql(f"DROP TABLE in_{entity}")
    spark.sql("DROP TABLE audit_requests")
