"""Readers and the table sink."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.schemas import conform
from tagloom.sources.csv_files import read_csv_strictly


def read_table(spark: SparkSession, name: str, entity: str | None = None, null_bad: bool = False) -> DataFrame:
    """A catalog table, checked against the schema of `entity` if given."""
    df = spark.table(name)
    return conform(df, entity, null_bad) if entity else df


def read_parquet(spark: SparkSession, path: str, entity: str | None = None, null_bad: bool = False) -> DataFrame:
    """Parquet files, checked against the schema of `entity` if given."""
    df = spark.read.parquet(path)
    return conform(df, entity, null_bad) if entity else df


def read_csv(spark: SparkSession, path: str, entity: str | None = None, null_bad: bool = False) -> DataFrame:
    """CSV files, each with its own header line; every column is text until `entity` types it.

    Columns are found by the header of each file, whatever their order. A line that does not fit its header ends the
    query; `csv_files.read_csv_files` gives such lines back instead.
    """
    df = read_csv_strictly(spark, path)
    return conform(df, entity, null_bad) if entity else df


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A path that nothing has used before, in the folder of spark.checkpoint.dir, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tagloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/tagloom-{uuid.uuid4().hex}/{name}"


def write_table(
    df: DataFrame,
    name: str,
    partition_by: str | None = "log_dte",
    path: str | None = None,
    rebalance: bool = True,
    replace_all: bool = False,
    days: Sequence[date | str] | None = None,
    buckets: tuple[int, str] | None = None,
) -> None:
    """Write the table `name`, as Parquet, split by `partition_by`.

    `days` declares the partition values that are written: each of them is replaced as a whole, also where `df` has no
    row for it, and all others stay; a row of another day ends the write before any day is touched. This is the way for
    a run over one business date and its repetition. Without `days`, the partitions that `df` has rows for are
    replaced. `replace_all`, or no `partition_by`, replaces the whole table. Columns go by name; `df` has to have
    those of the table.

    `buckets` (a number and a column) deals the rows of each partition to so many files by the column, so that joins and
    groups by it need no shuffle; it is fixed when the table is made. No other setting of the session plays a part, and
    none is changed.

    With `rebalance` the rows are gathered by partition value first, so that each task
    opens few files; adaptive execution splits a value that is too large for one task.
    Without it the rows are written where they are, which saves a shuffle where they
    belong to few partitions anyway, such as one business date.
    """
    spark = df.sparkSession
    if days is not None and not partition_by:
        raise ValueError("days without a column to split by")
    there = spark.catalog.tableExists(name)
    if days is not None and not there:
        _create(df.limit(0), name, partition_by, path, buckets)
        there = True
    if not partition_by or replace_all or not there:
        _create(_gathered(df, partition_by, rebalance, buckets), name, partition_by, path, buckets)
        return
    columns = spark.table(name).columns
    if {c.lower() for c in columns} != {c.lower() for c in df.columns}:
        raise ValueError(f"{name}: columns differ: {sorted(columns)} and {sorted(df.columns)}")
    if days is None:
        days = [r[0] for r in df.select(partition_by).distinct().collect()] if bucket_column(spark, name) else None
    if days is None:
        _replace_found(_gathered(df, partition_by, rebalance, None), name, partition_by)
    else:
        _replace_days(df, name, partition_by, days, rebalance, buckets or _buckets_of(spark, name))


def _gathered(df: DataFrame, partition_by: str | None, rebalance: bool, buckets: tuple[int, str] | None) -> DataFrame:
    if buckets:  # each bucket of a day is one task's, else every task would open a file for each
        return df.repartition(buckets[0], buckets[1]) if rebalance else df
    return df.hint("rebalance", partition_by) if partition_by and rebalance else df


def _create(rows: DataFrame, name: str, partition_by: str | None, path: str | None, buckets: tuple[int, str] | None) -> None:
    writer = rows.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def bucket_column(spark: SparkSession, name: str) -> str | None:
    """The column that a table is dealt to buckets by, from the catalog."""
    return next((c.name for c in spark.catalog.listColumns(name) if c.isBucket), None)


def _buckets_of(spark: SparkSession, name: str) -> tuple[int, str] | None:
    column = bucket_column(spark, name)
    return (int(_described(spark, name)["Num Buckets"]), column) if column else None


def shared_buckets(spark: SparkSession, *names: str) -> str | None:
    """The column that all these tables are dealt to the same number of buckets by, if they are."""
    found = {_buckets_of(spark, name) for name in names}
    one = found.pop()
    return one[1] if one and not found else None


def _replace_found(rows: DataFrame, name: str, partition_by: str) -> None:
    """Replace the partitions that `rows` has; the mode belongs to this one write."""
    spark = rows.sparkSession
    place = _described(spark, name)["Location"]
    writer = rows.select(*spark.table(name).columns).write.mode("overwrite").format("parquet")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).save(place)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def _replace_days(
    df: DataFrame, name: str, by: str, days: Sequence[date | str], rebalance: bool, buckets: tuple[int, str] | None
) -> None:
    """Replace each of `days` by its rows, be they none, with one static overwrite a day."""
    spark = df.sparkSession
    kind = df.schema[by].dataType
    declared = [F.lit(d).cast(kind) for d in days]
    columns = [c for c in spark.table(name).columns if c.lower() != by.lower()]
    for i, (day, value) in enumerate(zip(days, declared)):
        rows = df.where(F.col(by) == value)
        if i == 0:  # a row of no declared day ends the first write, before it replaces anything
            known = F.coalesce(F.col(by).isin(declared), F.lit(False))
            stray = F.raise_error(F.concat(F.lit(f"{name}: a row of another {by} than those declared: "), F.coalesce(F.col(by).cast("string"), F.lit("null"))))
            rows = df.where(F.when(known, F.col(by) == value).otherwise(stray.cast("boolean")))
        rows = _gathered(rows, by, rebalance, buckets).select(*columns)
        text = str(day).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({by} = '{text}') SELECT * FROM {{rows}}", rows=rows)


def newest_partition(spark: SparkSession, name: str, by: str = "log_dte") -> str | None:
    """The greatest value of the partition column that has rows, as text; None without any.

    The values come from the catalog. A partition that was emptied is still listed there, so the greatest ones are
    looked at, one row each, until one has a row: no file of an older day is opened.
    """
    spec = F.regexp_extract("partition", f"(?:^|/){by}=([^/]*)", 1)
    kind = spark.table(name).schema[by].dataType
    listed = spark.sql(f"SHOW PARTITIONS {name}").select(F.url_decode(spec).alias("v")).where("v != '__HIVE_DEFAULT_PARTITION__'")
    values = listed.distinct().orderBy(F.col("v").cast(kind).desc()).collect()  # one for each partition
    for row in values:
        if not spark.table(name).where(F.col(by) == F.lit(row.v).cast(kind)).limit(1).isEmpty():
            return row.v
    return None


def read_newest(spark: SparkSession, name: str, of: str | None = None, by: str = "log_dte") -> DataFrame:
    """Rows of the table `name` of the newest day of the table `of`, or of its own; the day is a literal in the plan, so
    that the scan lists that one partition."""
    newest = newest_partition(spark, of or name, by)
    rows = spark.table(name)
    return rows.where(F.col(by) == F.lit(newest).cast(rows.schema[by].dataType))
