"""CSV files with a header line each, whatever the order of their columns.

Spark's own reader takes the header of one file for all. Here every file is read by its own header: files with the same
header are one scan, and the scans meet by column name. A line that does not fit its header is not turned into nulls: it
is given back with its file and line number, or ends the query.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CORRUPT = "_corrupt"
#: Quotes are doubled inside quoted values; each line is one record.
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "quote": '"', "escape": '"'}
_BOM = "﻿"


class CsvFiles(NamedTuple):
    """What CSV files hold: `rows` by column name, all texts; `bad` lines (file, line, text, reason); `counts` of each
    file (file, lines, rows, bad, blank), of which lines = rows + bad + blank + 1 for the header."""

    rows: DataFrame
    bad: DataFrame
    counts: DataFrame


class _Scan(NamedTuple):
    """The lines of files that share a header."""

    columns: list[str]
    lines: DataFrame  # _file, _block, _id, _text, _kind, and _row, the values by column


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every line with its file, where its part of the file starts, and a number that rises by one inside such a part."""
    where = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    text = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return text.select(F.col("value").alias("_text"), *where, F.monotonically_increasing_id().alias("_id"))


def _blank(text: Column) -> Column:
    return F.trim(text) == ""


def headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """The files of each header text: the first line of a file that is not blank.

    One pass over the lines, merged in each task; the driver gets one line a file, as it holds the list of files anyway.
    """
    lines = _lines(spark, paths).where((F.col("_block") == 0) & ~_blank(F.col("_text")))
    first = lines.groupBy("_file").agg(F.min_by("_text", "_id").alias("header")).orderBy("_file").collect()
    found: dict[str, list[str]] = {}
    for row in first:
        found.setdefault(row.header, []).append(row._file)
    return found


def _names(header: str, file: str) -> list[str]:
    """The column names of a header, without outer spaces."""
    names = [n.strip() for n in next(csv.reader([header.removeprefix(_BOM)]))]
    low = [n.lower() for n in names]
    if "" in low or len(set(low)) < len(low):
        raise ValueError(f"{file}: a column without a name, or two of one name: {header}")
    return names


def _scan(spark: SparkSession, header: str, files: list[str], columns: Sequence[str]) -> _Scan:
    """The lines of `files`, judged: header, blank, row, or why not a row."""
    names = _names(header, files[0])
    by_name = {n.lower(): f"c{i}" for i, n in enumerate(names)}
    absent = [c for c in columns if c.lower() not in by_name]
    other = [n for n in names if n.lower() not in {c.lower() for c in columns}]
    if absent or other:
        raise ValueError(f"{files[0]}: columns {', '.join(absent) or 'none'} missing, {', '.join(other) or 'none'} added")
    schema = ", ".join([f"c{i} string" for i in range(len(names))] + [f"{_CORRUPT} string"])
    text = F.col("_text")
    parsed = _lines(spark, files).withColumn("_parsed", F.from_csv("_text", schema, _OPTIONS))
    open_quote = (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1
    kind = (
        F.when(_blank(text), "blank")
        .when(text == header, "header")
        .when(open_quote, "unclosed")
        .when(F.col(f"_parsed.{_CORRUPT}").isNotNull(), "columns")
        .otherwise("row")
    )
    row = F.struct(*[F.col("_parsed")[by_name[c.lower()]].alias(c) for c in columns])
    return _Scan(list(columns), parsed.select("_file", "_block", "_id", "_text", kind.alias("_kind"), row.alias("_row")))


def _bad(scan: _Scan) -> DataFrame:
    """The lines that are no rows, with their number in the file.

    A file that is cut into parts has its lines counted by part, one row for each; the parts before give the rest.
    """
    parts = scan.lines.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_lines"))
    header = F.min_by("_id", F.struct("_block", "_id"))
    first = scan.lines.where(F.col("_kind") == "header").groupBy("_file").agg(header.alias("_header"))
    # the parts of one file meet in a task: one row for each, some 100 MB of file apart
    before = F.sum("_lines").over(Window.partitionBy("_file").orderBy("_block")) - F.col("_lines")
    placed = parts.withColumn("_before", before).join(first, "_file")
    odd = scan.lines.where(~F.col("_kind").isin("row", "blank")).select("_file", "_block", "_id", "_text", "_kind")
    odd = odd.join(placed, ["_file", "_block"]).where(F.col("_id") != F.col("_header"))
    return odd.select(
        F.col("_file").alias("file"),
        (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"),
        F.col("_text").alias("text"),
        F.when(F.col("_kind") == "header", "header again").otherwise(F.col("_kind")).alias("reason"),
    )


def _counts(scan: _Scan) -> DataFrame:
    kind = F.col("_kind")
    counted = scan.lines.groupBy(F.col("_file").alias("file")).agg(
        F.count("*").alias("lines"), F.count_if(kind == "row").alias("rows"), F.count_if(kind == "blank").alias("blank")
    )
    return counted.select("file", "lines", "rows", (F.col("lines") - F.col("rows") - F.col("blank") - 1).alias("bad"), "blank")


def read_csv_files(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> CsvFiles:
    """The rows of CSV files, and the lines that are none.

    Every file has a header line, the first that is not blank, and its own order of columns; names compare without case
    and outer spaces, and the names of the first file, or `columns`, are those of the result. A file with other columns
    than these ends the call. Short and long lines (`columns`), lines with an open quote (`unclosed`) and further copies
    of the header line (`header again`) are no rows. An empty file has none; neither has a folder without lines. Empty values, quoted or not, are null.
    """
    found = headers(spark, paths)
    if not found:
        none = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns or []) or "nothing string")
        bad = spark.createDataFrame([], "file string, line long, text string, reason string")
        return CsvFiles(none, bad, spark.createDataFrame([], "file string, lines long, rows long, bad long, blank long"))
    if columns is None:
        text, files = next(iter(found.items()))
        columns = _names(text, files[0])
    scans = [_scan(spark, text, files, columns) for text, files in found.items()]
    rows = [s.lines.where(F.col("_kind") == "row").select("_row.*") for s in scans]
    return CsvFiles(*(reduce(DataFrame.unionByName, frames) for frames in (rows, map(_bad, scans), map(_counts, scans))))


def read_csv_strictly(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of CSV files; a line that is none ends the query with its file and text."""
    found = headers(spark, paths)
    if not found:
        return read_csv_files(spark, paths, columns).rows
    if columns is None:
        text, files = next(iter(found.items()))
        columns = _names(text, files[0])
    frames = []
    for text, files in found.items():
        lines = _scan(spark, text, files, columns).lines
        what = F.concat("_file", F.lit(": not a row ("), "_kind", F.lit("): "), "_text")
        is_row = F.when(F.col("_kind").isin("columns", "unclosed"), F.raise_error(what).cast("boolean"))
        frames.append(lines.where(F.coalesce(is_row, F.col("_kind") == "row")).select("_row.*"))
    return reduce(DataFrame.unionByName, frames)
