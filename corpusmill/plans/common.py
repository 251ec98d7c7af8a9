"""Tables and SQL pieces that the plans share."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_any(text: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), {quoted(w)})" for w in words) + ")"


def sql_count(text: str, words: Iterable[str]) -> str:
    return "(" + " + ".join(f"CAST(contains(lower({text}), {quoted(w)}) AS INTEGER)" for w in words) + ")"


def sql_lookup(mapping: Mapping[str, str], key: str, default: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items()) + f" ELSE {quoted(default)} END"


WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"
NON_ASCII = r"length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) / greatest(length(text), 1)"
STRIP = r"regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')"
