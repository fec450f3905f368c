"""Declared days, the newest day from the catalog, buckets."""

from __future__ import annotations

import sys
from datetime import date

import pytest
from helpers import bag, final_plan, plan
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tagloom.operators.details import dedup_details
from tagloom.operators.requests import enrich_main
from tagloom.plans.audit import audit_flow, flow_over_tables
from tagloom.sources import tables

MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture
def fresh(spark):
    """Names of tables that are dropped afterwards."""
    names = []

    def name(text):
        spark.sql(f"DROP TABLE IF EXISTS {text}")
        names.append(text)
        return text

    yield name
    for text in names:
        spark.sql(f"DROP TABLE IF EXISTS {text}")


def rows(spark, *of):
    return spark.createDataFrame([(f"u{n}", n, date(2024, 1, d)) for d, n in of], "uid string, n int, log_dte date")


@pytest.mark.parametrize("mode", ["STATIC", "DYNAMIC"])
@pytest.mark.parametrize("buckets", [None, (3, "uid")])
def test_declared_days_are_replaced_also_by_nothing(spark, conf, fresh, mode, buckets):
    conf(sources__partitionOverwriteMode=mode)
    name = fresh("declared")
    write = lambda df, *days: tables.write_table(df, name, days=days, buckets=buckets)
    write(rows(spark, (1, 1), (1, 2), (2, 3)), "2024-01-01", date(2024, 1, 2))
    assert bag(spark.table(name)) == bag(rows(spark, (1, 1), (1, 2), (2, 3)))
    write(rows(spark), "2024-01-01")  # the day has no rows any more
    assert bag(spark.table(name)) == bag(rows(spark, (2, 3)))
    write(rows(spark, (1, 7), (3, 8)).select("log_dte", "n", "uid"), "2024-01-01", "2024-01-03")
    assert bag(spark.table(name)) == bag(rows(spark, (1, 7), (2, 3), (3, 8)))
    assert spark.conf.get(MODE) == mode
    assert tables.bucket_column(spark, name) == (buckets and "uid")


def test_a_row_of_another_day_ends_the_write_before_any_day_is_touched(spark, fresh):
    name = fresh("strays")
    tables.write_table(rows(spark, (1, 1), (2, 2)), name)
    for stray in (rows(spark, (1, 5), (2, 6), (4, 7)), rows(spark, (1, 5)).union(rows(spark, (2, 6)).withColumn("log_dte", F.lit(None).cast("date")))):
        with pytest.raises(Exception, match="another log_dte than those declared: (2024-01-04|null)"):
            tables.write_table(stray, name, days=["2024-01-01", "2024-01-02"])
        assert bag(spark.table(name)) == bag(rows(spark, (1, 1), (2, 2)))


@pytest.mark.parametrize("mode", ["STATIC", "DYNAMIC"])
@pytest.mark.parametrize("buckets", [None, (2, "uid")])
def test_days_that_are_found_are_replaced_whatever_the_session_says(spark, conf, fresh, mode, buckets):
    conf(sources__partitionOverwriteMode=mode)
    name = fresh("found")
    tables.write_table(rows(spark, (1, 1), (2, 2)), name, buckets=buckets)
    tables.write_table(rows(spark, (2, 9), (5, 5)), name)
    assert bag(spark.table(name)) == bag(rows(spark, (1, 1), (2, 9), (5, 5)))
    assert spark.conf.get(MODE) == mode


def test_newest_day_comes_from_the_catalog(spark, fresh, tmp_path):
    name = fresh("days_of_log")
    place = tmp_path / "log"
    tables.write_table(rows(spark, (1, 1), (2, 2), (3, 3)), name, path=str(place))
    tables.write_table(rows(spark), name, days=["2024-01-09"])  # listed without rows
    # an older day that no reader could open
    for file in (place / "log_dte=2024-01-01").glob("*.parquet"):
        file.write_bytes(b"no parquet")
    assert tables.newest_partition(spark, name) == "2024-01-03"
    newest = tables.read_newest(spark, name)
    assert bag(newest) == bag(rows(spark, (3, 3)))
    text = plan(newest)
    assert "2024-01-03" in text and text.count("FileScan") == 1 and "Subquery" not in text
    assert all("2024-01-03" in f for f in newest.inputFiles())
    # the rows of one table of the newest day of another
    other = fresh("other_log")
    tables.write_table(rows(spark, (2, 4), (3, 5), (4, 6)), other)
    assert bag(tables.read_newest(spark, other, of=name)) == bag(rows(spark, (3, 5)))


def test_newest_day_of_a_table_without_rows(spark, fresh):
    name = fresh("empty_log")
    tables.write_table(rows(spark), name, days=["2024-01-01"])
    assert tables.newest_partition(spark, name) is None
    assert tables.read_newest(spark, name).count() == 0


def test_bucketed_tables_are_joined_where_they_lie(spark, sf_dir, fresh, conf):
    conf(autoBroadcastJoinThreshold="-1")
    x = registry._Inputs(spark, sf_dir)
    main, details = fresh("b_main"), fresh("b_details")
    tables.write_table(x.main, main, partition_by=None, buckets=(4, "uid"))
    tables.write_table(x.details, details, partition_by=None, buckets=(4, "uid"))
    assert tables.shared_buckets(spark, main, details) == "uid"
    grouped = spark.table(details).groupBy("uid", "log_dte").agg(F.max("tagvalue").alias("tagvalue"))
    by = ("uid", "log_dte")
    joined = enrich_main(grouped, spark.table(main), by=by, colocated_by="uid")
    assert "Exchange" not in final_plan(joined)
    assert bag(joined) == bag(enrich_main(grouped, spark.table(main), by=by))
    dedup = dedup_details(spark.table(details).where("tagvalue IS NOT NULL"))
    assert final_plan(dedup).count("Exchange") <= 1
    unequal = fresh("b_other")
    tables.write_table(x.main, unequal, partition_by=None, buckets=(8, "uid"))
    assert tables.shared_buckets(spark, unequal, details) is None


def test_flow_over_bucketed_tables(spark, sf_dir, fresh):
    """The flow finds the buckets itself and gives the same rows."""
    x = registry._Inputs(spark, sf_dir)
    empty = F.lit("")
    frames = {
        "audit_details": x.details, "audit_main": x.main, "cust_link": x.custlink, "chnl_map": x.chnl_map,
        "rule_config": x.rules, "event_map": x.event_map, "err_map": x.err_map,
    }
    names = {entity: fresh(f"flow_{entity}") for entity in frames}
    for entity, df in frames.items():
        large = entity in ("audit_details", "audit_main")
        tables.write_table(df, names[entity], partition_by=None, buckets=(4, "uid") if large else None)
    flow = flow_over_tables(spark, names)
    assert empty is not None and "_right_uid" in flow._jdf.queryExecution().analyzed().toString()
    assert bag(flow) == bag(audit_flow(**frames))


def test_the_flow_types_its_inputs(spark, sf_dir):
    x = registry._Inputs(spark, sf_dir)
    frames = dict(
        audit_details=x.details, audit_main=x.main, cust_link=x.custlink, chnl_map=x.chnl_map, rule_config=x.rules,
        event_map=x.event_map, err_map=x.err_map,
    )
    as_text = {k: v.select(*[F.col(c).cast("string") if c in ("active", "chnl_key", "log_dte") else c for c in v.columns]) for k, v in frames.items()}
    assert bag(audit_flow(**as_text)) == bag(audit_flow(**frames))
    bad = frames | {"audit_main": x.main.withColumn("log_dte", F.lit("yesterday"))}
    with pytest.raises(Exception, match="audit_main.log_dte: not a date: yesterday"):
        audit_flow(**bad).collect()


def test_audit_queries_do_without_the_training_libraries(spark, monkeypatch, capsys):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("tagloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(registry.queries()) == set(registry.core_queries())
    assert set(registry.oracle_sql()) >= set(registry.core_queries())
    assert "left out" in capsys.readouterr().err
