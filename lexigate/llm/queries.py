"""The registered queries of this subpackage: thin digests of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.llm import (
    decontaminate,
    hard_negatives,
    lattice,
    mixing,
    mtree,
    pii,
    prefix_trie,
    quality,
    secrets,
    simhash,
    suffixes,
    token_files,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUALITY_LEAST = 0.3


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        F.coalesce(quality.fold(F.col("doc_id")) == quality.HELD, F.lit(False)).alias("held_out"),
        quality.quality_score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= QUALITY_LEAST).cast("int"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.private_spans(F.col("text"), pii.train(docs))
    return docs.select("doc_id", found.alias("s")).select("doc_id", "s.*")


def op5_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.likelihoods(table(spark, sf_dir, "documents"), fitted=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mtree.top_k(table(spark, sf_dir, "embeddings"))
    return found.select("query_id", "rank", "vec_id", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "size", "source_size", "target", "taken")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", secrets.secret_spans(F.col("text")).alias("s")).select(
        "doc_id", "s.*"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.expr("vec_id % 7 = 0"), (F.col("label").cast("long") + 1) % 10)
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.coalesce(moved, "label"))
    return hard_negatives.mine(rows).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_quality,
        op3_repeated_passages,
        op4_pii,
        op5_likelihood,
        op6_simhash,
        op7_topk,
        op8_decontamination,
        op9_source_mix,
        op10_secret_scan,
        op11_hard_negatives,
        op12_token_files,
        op13_prefix_trie,
    )
}
