"""The first rows of each class in a reproducible random order, without ordering a class.

The order is the md5 of key and seed.  What is kept of a class is known by the md5 of its last
row kept: counts by md5 prefix say which prefix holds that row, and only that prefix's keys are
numbered.  Rows themselves are never shuffled or sorted, only compared with their class's cut.
Rows that share a key stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx

#: Hexadecimal digits of the counted prefix: a class is counted in 4096 parts, of which one is numbered.
DIGITS = 3


def marked(df: DataFrame, column: str | None, limits: DataFrame, key: str, seed: int, out: str = "kept__") -> DataFrame:
    """Adds ``out``: whether a row is among the first ``cap`` of its class's ``n``.

    ``limits`` has (class, n, cap), one row a class; without ``column`` all rows are one class and
    ``limits`` is (n, cap).  A class without limits keeps nothing; null is a class.
    """
    label = F.lit(0) if column is None else F.col(column)
    if column is None:
        limits = limits.select(F.lit(0).alias("class"), "n", "cap")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    slim = df.select(label.alias("c"), tx.rank_key(F.col(key), seed).alias("h"), F.col(key).alias("k")).withColumn("p", F.substring("h", 1, DIGITS))
    partial = limits.where((F.col("cap") > 0) & (F.col("cap") < F.col("n"))).select("class", "cap")
    parts = slim.groupBy("c", "p").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = parts.withColumn("before", before).join(partial, same("c", "class")).where((F.col("before") < F.col("cap")) & (F.col("cap") <= F.col("before") + F.col("m")))
    at = at.select(F.col("class").alias("d"), F.col("p").alias("q"), (F.col("cap") - F.col("before")).alias("rest"))
    inside = slim.join(at, same("c", "d") & (F.col("p") == F.col("q"))).withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy("h", "k")))
    last = inside.where("r = rest").select(F.col("c").alias("e"), F.col("h").alias("h__"), F.col("k").alias("k__"))
    cuts = limits.join(last, same("class", "e"), "left").select(F.col("class").alias("class__"), F.col("n").alias("n__"), F.col("cap").alias("cap__"), "h__", "k__")
    own = tx.rank_key(F.col(key), seed)
    upto = (own < F.col("h__")) | ((own == F.col("h__")) & (F.col(key) <= F.col("k__")))
    kept = F.when(F.col("cap__") >= F.col("n__"), True).when(F.col("cap__") > 0, upto).otherwise(False)
    return df.join(cuts, label.eqNullSafe(F.col("class__")), "left").withColumn(out, F.coalesce(kept, F.lit(False))).drop("class__", "n__", "cap__", "h__", "k__")


def heads(df: DataFrame, column: str | None, limits: DataFrame, key: str, seed: int) -> DataFrame:
    """The rows that ``marked`` keeps."""
    return marked(df, column, limits, key, seed).where("kept__").drop("kept__")
