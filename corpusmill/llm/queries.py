"""The queries of the training-data operators, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, ctw, decontaminate, jaccard, mixing, quality, sharding, spans, token_counts, warc
from .shared import table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_runs(table(spark, sf_dir, "documents"))


def op2_permutation_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"), F.round("mix_probability", 6).alias("probability"))


def op6_ctw_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op8_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_packages(table(spark, sf_dir, "pages"))
    return warc.read_packages(written).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.expr("crc32(CAST(coalesce(CAST(doc_id AS STRING), '') AS BINARY)) % 3 = 1")
    return quality.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_permutation_ann, op3_decontamination, op4_rendezvous_sharding, op5_source_mixing,
        op6_ctw_scoring, op7_jaccard_join, op8_warc_packages, op9_token_counts, op10_quality_classifier,
    )
}

ORACLES = {
    "op3_decontamination": decontaminate.containment_sql(),
    "op5_source_mixing": mixing.mixing_sql(),
    "op7_jaccard_join": jaccard.components_sql(),
    "op8_warc_packages": warc.WARC_SQL,
}
