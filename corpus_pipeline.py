"""A training corpus from ``documents``: reject, deduplicate, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's rows
as Parquet into the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontaminate, jaccard, mixing, quality, sharding
from corpusmill.llm.shared import materialize, table


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores under one half go.

    Only the text decides: a null text goes by the score of an empty one, equal texts stay or go
    together, very long ones are scored whole, null and repeated keys play no part.  Without labels of both kinds
    every text has the share of good labels as its score.  An empty table stays empty; all columns stay as they are.
    """
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies stays, that with the smallest id.

    Rows with a null id or without words stay.  Of rows that share an id and link, or are equal, one stays (see
    ``jaccard.one_of_each``); texts of any length are compared whole.  An empty table stays empty; all columns stay as they are.
    """
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, by 0.8 of its shingles, go.

    Only the text decides: null texts and those without words stay, repeated rows stay or go together, an item is found
    anywhere in a very long text, null ids play no part.  Without items, or for an empty table, all stays as it is.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as come in, drawn so that sources, languages and topics meet their target
    weights; documents of rare cells may come several times.

    The id decides the draw, so rows that share one, or have a null id, and lie in the same cell have as many copies each.  Null sources and
    languages are values of their own; texts without tokens come once at most.  Very long texts weigh by their bytes.
    An empty table stays empty; the columns are those of the documents.
    """
    return mixing.mix_sources(docs, budget=1.0).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard among 40, which replaces a column of that name.

    Only the id decides: rows with a null id share a shard, as do repeated rows; texts play no part.  An empty table stays empty.
    """
    return sharding.assign_shards(docs, dict.fromkeys(range(40), 1.0))


STAGES = [
    ("quality classifier", reject_poor),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("mixing to target weights", mix_to_weights),
    ("sharding", shard),
]

#: The classifier can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages.  What the stages wrote stays until ``shared.remove_written``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{i}")
    return docs
