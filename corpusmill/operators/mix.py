"""Sampling, mixing and splitting; every random order is the md5 of key and seed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import order


def _sizes(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def mix_sources(df: DataFrame, weights: Mapping[str, float], total: int, *, column: str = "source", key: str = "doc_id", seed: int = 42) -> DataFrame:
    """``int(total * weight)`` rows of each source: a random part, or whole copies in turn where it
    has too few; sources without weight, or none over 0, are left out.  Adds copy (0 first).

    Every row has as many copies as the target holds whole rounds of its source; the first rows in
    random order, as many as are left over, have one more.
    """
    targets = {s: int(total * w) for s, w in weights.items() if w > 0}
    if not targets:
        raise ValueError("no source with a weight over 0")
    target = F.element_at(F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]), F.col("class")).cast("long")
    df = df.where(F.col(column).isin(*targets))
    limits = _sizes(df, column).withColumn("t", target).select("class", "n", (F.col("t") % F.col("n")).alias("cap"), F.floor(F.col("t") / F.col("n")).alias("rounds"))
    rows = order.marked(df, column, limits.drop("rounds"), key, seed).join(limits.select(F.col("class").alias("class__"), "rounds"), F.col(column) == F.col("class__"))
    copies = F.col("rounds") + F.col("kept__").cast("long")
    return rows.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("kept__", "class__", "rounds")


def composition(df: DataFrame, weights: Mapping[str, float], column: str = "source") -> DataFrame:
    """(source, n, actual, target) of a mix."""
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("all__"))
    return counts.crossJoin(whole).select(column, "n", (F.col("n") / F.col("all__")).alias("actual"), F.element_at(table, F.col(column)).alias("target"))


def subsample(df: DataFrame, weights: Mapping[str, float], total: int, *, column: str = "source", key: str = "doc_id", seed: int = 42) -> DataFrame:
    """At most ``int(total * weight / sum of weights)`` rows of each source, never repeated."""
    whole = sum(weights.values())
    table = F.create_map(*[F.lit(x) for s, w in weights.items() for x in (s, int(total * w / whole))])
    return order.heads(df, column, _sizes(df, column).withColumn("cap", F.element_at(table, F.col("class")).cast("long")), key, seed)


#: Columns that a stratified sample looks for, in this order.
STRATA = ("category", "type", "intent", "label", "department")


def stratified_sample(df: DataFrame, n: int, *, key: str, column: str | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer): of each stratum its share, one at least; then filled up,
    or cut, in random order.  Without ``column`` the first of STRATA that is there; a plain random
    sample if none is.

    Strata come first in one order of all rows, so that its head of n is the sample.
    """
    column = column or next((c for c in STRATA if c in df.columns), None)
    if column is None:
        return random_sample(df, n, key=key, seed=seed)
    sizes = _sizes(df, column)
    sizes = sizes.crossJoin(sizes.agg(F.sum("n").alias("all")))
    quota = F.least(F.col("n"), F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("n") / F.col("all"))))
    rows = order.marked(df, column, sizes.select("class", "n", quota.alias("cap")), key, seed)
    return rows.orderBy(F.col("kept__").desc(), tx.rank_key(F.col(key), seed), key).limit(n).drop("kept__")


def random_sample(df: DataFrame, n: int, *, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(tx.rank_key(F.col(key), seed), key).limit(n)


def split(df: DataFrame, first_share: float, *, key: str, seed: int = 42, names: tuple[str, str] = ("train", "eval")) -> DataFrame:
    """Adds split: the first ``int(rows * first_share)`` in random order are names[0], the rest names[1]."""
    n = df.agg(F.count(F.lit(1)).alias("n")).withColumn("cap", F.floor(F.col("n") * F.lit(first_share)))
    return order.marked(df, None, n, key, seed).withColumn("split", F.when(F.col("kept__"), names[0]).otherwise(names[1])).drop("kept__")


def union_sources(frames: Mapping[str, DataFrame], column: str = "source") -> DataFrame:
    """All frames by column name, nulls where one lacks a column, each named in ``column``."""
    if not frames:
        raise ValueError("no source to join")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(column, F.lit(n)) for n, df in frames.items()])


def lacking_messages(frames: Mapping[str, DataFrame], column: str = "messages") -> list[str]:
    return sorted(n for n, df in frames.items() if column not in df.columns)
