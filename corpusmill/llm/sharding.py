"""Sharding by rendezvous hashing of stable record keys over weighted shards (native).

Every shard scores a key with ``-weight / ln(u)``, u a hash of key and shard in (0, 1); the
highest score holds the key.  A shard more takes keys only into itself; a changed weight moves
only the share that it gains or loses.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

#: Rows of one bucket that one task numbers without being split.
CROWD = 1_000_000


def rendezvous(key: Column, shards: Mapping[int, float]) -> Column:
    """The shard of ``key`` among ``{id: weight}``; ties go to the larger id."""
    if not shards or any(w <= 0 for w in shards.values()):
        raise ValueError("every shard needs a positive weight")
    options = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w")) for i, w in sorted(shards.items())])

    def scored(s: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit(":"), s["id"].cast("string"))), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-s["w"] / F.ln(u)).alias("score"), s["id"].alias("id"))

    return F.array_max(F.transform(options, scored))["id"]


def record_key(column: Column) -> Column:
    """The key as text; null keys share one of their own."""
    return F.coalesce(column.cast("string"), F.lit("\u0000"))


def assign_shards(docs: DataFrame, shards: Mapping[int, float], *, grown: Mapping[int, float] | None = None, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with the column ``out`` (and ``grown_shard``); replaces columns of these names.

    Only the key decides: null keys go to one shard, repeated rows to the same one, an empty
    table stays empty.
    """
    found = docs.withColumn(out, rendezvous(record_key(docs[key]), shards))
    return found if grown is None else found.withColumn("grown_shard", rendezvous(record_key(docs[key]), grown))


def shard_manifest(docs: DataFrame, n_shards: int = 40, *, key: str = "doc_id", text: str = "text", buckets: int = 256, parts: int = 16) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    Shards 0 to n_shards-1 weigh the same.  size: UTF-8 bytes of the text plus 16; a null text
    has none, its crc32 is that of nothing (0).  Texts of any length are read whole; repeated rows
    get slots of their own beside each other, in any order as they are equal; null keys are one key; an empty
    table gives no rows; other columns, also of these names, are ignored.  Slots run without gaps from 0 in each shard,
    by bucket of the key's hash, part by text, key, crc32 and size.  A first pass over the key column counts
    each (shard, bucket, part) - at most n_shards * buckets * parts rows, which bounds what is broadcast - so
    that the numbering needs no task that sees a whole shard.  A key's rows lie in ``parts`` parts by
    their text's hash, so that one key with very many rows (null, say) is numbered by several tasks.
    """
    equal = dict.fromkeys(range(n_shards), 1.0)
    held = record_key(docs[key])
    bucket = F.pmod(F.xxhash64(held), F.lit(buckets)) * F.lit(parts)

    def counts(bucket: Column) -> tuple[list[Column], DataFrame]:
        place = [rendezvous(held, equal).alias("shard"), bucket.cast("int").alias("bucket")]
        return place, materialize(docs.select(*place).groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")), "slots").coalesce(1)

    place, counted = counts(bucket)
    most, mean = counted.agg(F.max("n"), F.avg("n")).first()
    if most is not None and most > max(CROWD, 4 * mean):  # a crowded key: its rows spread over parts by text
        place, counted = counts(bucket + F.pmod(F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(
        docs[key].alias(key),
        (F.octet_length(body).cast("long") + F.lit(16)).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        *place,
        rendezvous(held, {**equal, n_shards: 1.0}).alias("grown_shard"),
    )
    order = Window.partitionBy("shard", "bucket").orderBy(key, "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(order) - 1)
        .join(F.broadcast(base), ["shard", "bucket"])
        .select(key, "size", "text_crc32", "law", "shard", (F.col("base") + F.col("nth")).alias("slot"), "grown_shard")
    )
