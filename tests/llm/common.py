"""Brute-force pieces for the tests."""

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text):
    return WORD.findall((text or "").encode().translate(_LOW))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


DOCS = "doc_id long, text string, lang string, source string, n_chars long, k long, t string"


def docs(spark, rows, schema="doc_id long, text string, lang string, source string"):
    """Rows (doc_id, text), with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}") for i, t in rows], schema)
    for c in ("k", "t", "n", "a", "h", "rank", "shard", "score", "mix_topic"):
        df = df.withColumn(c, F.lit("x"))
    return df


def sample(spark, name="documents", sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
