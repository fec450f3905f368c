"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    decontamination,
    id_files,
    language_model,
    licenses,
    merge_replay,
    merkle,
    quality,
    secrets,
    simhash,
    token_counts,
    vafile,
    whitening,
    word_bpe,
)
from tagloom.llm.common import table


def fold(key: str, n: int) -> Column:
    """The remainder by which rows are held out: CRC-32 of the id as text, mod n. Null ids have fold null."""
    return F.crc32(F.col(key).cast("string")) % n


def op1_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.crc32_of_ids(id_files.round_trip(table(spark, sf_dir, "documents")))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    name = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))
    base = F.filter("spans", lambda s: s.kind != "novel")
    counts = [_count(kind).alias(f"n_{kind}") for kind in secrets.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", name), ",").alias("spans"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"))
    return token_counts.suffix_sums(token_counts.length_histogram(lengths))


def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = word_bpe.encode_decode(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """The documents with a path: thousand and hundred of the id, language and source as directories. Every hundredth
    document is the licence file of its hundred, every thousandth that of its thousand."""
    thousand, hundred = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100))
    inner = [F.coalesce(c, F.lit("unknown")) for c in ("lang", "source")]
    path = (
        F.when(F.col("doc_id") % 1000 == 0, F.concat_ws("/", thousand, F.lit("LICENSE")))
        .when(F.col("doc_id") % 100 == 0, F.concat_ws("/", thousand, hundred, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", thousand, hundred, *inner, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    )
    return docs.select("doc_id", "text", F.when(F.col("doc_id").isNotNull(), path).alias("path"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(document_paths(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "path", "license", "origin", F.col("levels").cast("int").alias("levels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), F.col("component").alias("component_id"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    return language_model.score_documents(table(spark, sf_dir, "documents"), held_out)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return quality.score(docs, model).select(
        "doc_id",
        # a row without id is in no fold and never learnt from
        F.coalesce(fold("doc_id", 4) == 2, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = merge_replay.encode_decode(table(spark, sf_dir, "documents"))
    decimals = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select(
        "doc_id", "n_tokens", F.sha2(decimals, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = merkle.document_leaves(table(spark, sf_dir, "documents"))
    return merkle.manifest(leaves, "lang", "doc_id").drop("lang")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_vector_topk,
        op2_token_files,
        op3_secret_scans,
        op4_token_counts,
        op5_word_bpe,
        op6_license_scans,
        op7_simhash,
        op8_decontamination,
        op9_language_model,
        op10_quality,
        op11_merge_replay,
        op12_merkle_manifest,
        op13_embedding_whitening,
    )
}
