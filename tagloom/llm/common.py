"""What several operators share: reading, per-text maps and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A-Z to a-z; no other character changes.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Rows in one batch for Python; Spark's own default is 10,000.
BATCH_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = str(Path(__file__).resolve().parents[2])


#: Keys longer than this are not remembered, so that a number of entries bounds the bytes.
LONG_KEY = 256


class Generations:
    """A bounded memory of a worker: what is used stays, what has not been used for a generation goes."""

    def __init__(self, size: int = 250_000):
        self.size, self.young, self.old = size, {}, {}
        self._seen = 0

    def turned(self) -> dict:
        """The young generation, after it has become the old one if it was full."""
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
            self._seen = 0
        return self.young

    def forget_long(self) -> None:
        """Drop the long keys among those that have come since the last call: those of one text, no more."""
        for key in [k for k in islice(reversed(self.young), len(self.young) - self._seen) if len(k) > LONG_KEY]:
            del self.young[key]
        self._seen = len(self.young)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a data directory; workers can import this package afterwards.

    Texts can be long, so batches for Python are made shorter where the session has Spark's own default.
    """
    if spark.conf.get(_BATCH, None) in (None, "10000"):
        spark.conf.set(_BATCH, BATCH_ROWS)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{_ROOT}".strip(":")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, else the context's; a local one only where neither is set and Spark runs
    locally."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.getCheckpointDir():
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tagloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/tagloom-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, whatever executors are lost later."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The columns of `packed`.
PACKED = ("_doc", "_text")


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row as its `_text` and a struct `_doc` of its other columns, so that no added name can clash with one."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_none")]
    return docs.select(F.struct(*rest).alias("_doc"), F.col(text).alias("_text"))


def unpacked(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` again."""
    return rows.select(*[(F.col("_text") if c == text else F.col("_doc")[c]).alias(c) for c in docs.columns])


def per_text(
    df: DataFrame,
    factory: Callable[[], Callable[..., tuple]],
    fields: str,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    more: Sequence[str] = (),
) -> DataFrame:
    """The columns `keep` and, for every row, what a function of the text gives.

    `factory` runs once in a task and returns the function. It gets the UTF-8 bytes of the whole text, empty for
    null, and the values of the columns `more`, and returns one value for each of `fields`. One text at a time is
    held as a Python value. A text that is kept goes to the task once.
    """
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)
    n = len(keep)
    columns = [*keep, *([] if text in keep else [text]), *more]
    place, first_more = columns.index(text), len(columns) - len(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, each = to_arrow_schema(schema), factory()
        for batch in batches:
            texts, rest = batch.column(place).cast(pa.binary()), batch.columns[first_more:]
            out: list[list] = [[] for _ in added]
            for i, value in enumerate(texts):
                for column, got in zip(out, each(value.as_py() or b"", *(c[i].as_py() for c in rest))):
                    column.append(got)
            arrays = [pa.array(v, type=arrow.field(n + k).type) for k, v in enumerate(out)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *arrays], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)
