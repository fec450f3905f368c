"""A training corpus from raw documents: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import decontamination, quality, secrets, simhash, word_bpe
from tagloom.llm.common import PACKED, packed, stored, table, unpacked
from tagloom.llm.queries import fold

#: No SQL can express the classifier's fit; the stages are tested against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Labels of one fold in four are never learnt from."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    scored = quality.score(packed(docs), model, PACKED, "_text")
    return unpacked(scored.where(F.col("score") >= quality.THRESHOLD), docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one with the smallest id."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside an occurrence of a benchmark window."""
    found = decontamination.decontaminate(packed(docs), table(spark, sf_dir, "benchmark"), keep=PACKED, text="_text")
    return unpacked(found.where(F.col("n_hit") == 0), docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret masked."""
    return secrets.mask_secrets(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every document."""
    return word_bpe.encode(docs).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("bpe encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
