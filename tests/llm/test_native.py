import math
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import mixing
from corpusmill.llm.sharding import assign_shards, rendezvous, shard_manifest

from .common import docs, sample


def place(key, weights):
    def score(i):
        u = ((xxhash.xxh64_intdigest(f"{key}:{i}", seed=42) >> 11) + 0.5) / 2**53
        return -weights[i] / math.log(u), i

    return max(map(score, weights))[1]


def test_manifest_against_brute_force(spark):
    rows = [(i, t) for i, t in sample(spark).select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in shard_manifest(sample(spark)).collect()}
    slots = {}
    for i, t in rows:
        r, raw = got[i], t.encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r["shard"] == place(i, dict.fromkeys(range(40), 1.0)) and r["grown_shard"] == place(i, dict.fromkeys(range(41), 1.0))
        assert r["grown_shard"] in (r["shard"], 40)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shard_odd_rows(spark):
    got = shard_manifest(docs(spark, [(None, None), (1, ""), (1, ""), (2, "é" * 50_000)])).collect()
    assert sorted(r["size"] for r in got) == [16, 16, 16, 100_016] and [r["text_crc32"] for r in got if r["doc_id"] is None] == [0]
    assert len({(r["shard"], r["slot"]) for r in got}) == 4
    assert shard_manifest(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        rendezvous(F.lit("a"), {0: 0.0})


def test_weights_hold(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id").withColumn("shard", F.lit("old"))
    n = {r["shard"]: r["count"] for r in assign_shards(df, {0: 1.0, 1: 3.0}).groupBy("shard").count().collect()}
    assert n[1] / n[0] == pytest.approx(3, rel=0.08)


def test_margins_meet_their_targets(spark):
    rows = [(i, "x" * 4 * (1 + i % 7), "en" if i % 3 else "de", "a" if i % 5 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.3, "de": 0.7}}
    cells = mixing.calibrated(df, targets, rounds=25)
    drawn = mixing._cells(df, "text").groupBy(*mixing.DIMENSIONS).agg(F.sum("tokens").alias("tokens")).join(cells, list(mixing.DIMENSIONS))
    for d in ("source", "lang"):
        sums = {r[d]: r["s"] for r in drawn.groupBy(d).agg(F.sum(F.col("tokens") * F.col("probability")).alias("s")).collect()}
        for v, w in targets[d].items():
            assert sums[v] / sum(sums.values()) == pytest.approx(w, abs=1e-3)
    got = mixing.mix_sources(df, targets, rounds=25).groupBy("lang").agg(F.sum("mix_tokens").alias("n")).collect()
    n = {r["lang"]: r["n"] for r in got}
    assert n["de"] / sum(n.values()) == pytest.approx(0.7, abs=0.05)


def test_a_budget_is_met_with_copies_of_rare_rows(spark):
    rows = [(i, "x" * 4 * (1 + i % 7), "en" if i % 3 else "de", "a" if i % 10 else "b") for i in range(3000)]
    df = spark.createDataFrame([*rows, (3000, "", "en", "b")], "doc_id long, text string, lang string, source string")
    got = mixing.mix_sources(df, {"source": {"a": 0.5, "b": 0.5}}, budget=1.0, rounds=25)
    n = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("mix_tokens").alias("n")).collect()}
    assert n["b"] / sum(n.values()) == pytest.approx(0.5, abs=0.03)
    assert sum(n.values()) == pytest.approx(sum(1 + i % 7 for i in range(3000)), rel=0.03)
    times = {r["doc_id"]: (r["c"], r["p"]) for r in got.groupBy("doc_id").agg(F.count("*").alias("c"), F.first("mix_probability").alias("p")).collect()}
    assert all(c in (int(p), int(p) + 1) for i, (c, p) in times.items() if i < 3000) and max(c for c, _ in times.values()) > 3
    assert times[3000][0] == 1


def test_one_rare_document_leaves_the_rest_in_the_pipeline(spark):
    rows = [(i, "some words " * (5 + i % 9), "en" if i % 3 else "de", "a" if i % 5 else "b") for i in range(3000)]
    kept = []
    for extra in ([], [(9999, "four words stand here", "xx", "b")]):
        df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, source string")
        kept.append(corpus_pipeline.mix_to_weights(spark, df, "").where("doc_id < 3000").select("doc_id").distinct().count())
    assert kept[0] > 2700 and kept[1] > 0.98 * kept[0]


def test_mix_odd_rows(spark):
    df = docs(spark, [(1, None), (2, ""), (3, "some text"), (3, "some text"), (None, "more")])
    nulls = df.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    for x in (df, nulls):
        got = mixing.mix_sources(x)
        assert got.columns == [c for c in x.columns if c != "mix_topic"] + ["mix_topic", "mix_tokens", "mix_probability"]
        assert sum(r["doc_id"] == 3 for r in got.collect()) in (0, 2)
    assert mixing.mix_sources(docs(spark, [])).count() == 0


def test_native_plans_have_no_python(spark):
    for df in (mixing.mix_sources(sample(spark)), shard_manifest(sample(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_targets_that_no_row_or_no_mixture_meets(spark):
    rows = [(i, "x" * 40, "en", "a" if i % 2 else "b") for i in range(40)] + [(100 + i, "x" * 40, "de", "a") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match="fr"):
        mixing.calibrated(df, {"lang": {"en": 0.5, "fr": 0.5}})
    with pytest.raises(ValueError, match="together"):  # German stands in one source only
        mixing.calibrated(df, {"lang": {"de": 0.9, "en": 0.1}, "source": {"a": 0.2, "b": 0.8}})
    assert mixing.calibrated(df, {"lang": {"de": 0.5, "en": 0.5, "fr": 0.0}}).count() == 3


def test_mix_very_long_texts_and_ties(spark):
    rows = [(1, "long " * 400_000), (2, "long " * 400_000), (3, "short text"), (4, "short text"), (5, "| a | b |")]
    got = {r["doc_id"]: (r["mix_topic"], r["mix_tokens"], r["mix_probability"]) for r in mixing.mix_sources(docs(spark, rows), budget=1.0).collect()}
    assert all(got[i] == got[j] for i, j in ((1, 2), (3, 4)) if i in got and j in got and i % 3 == j % 3)
    assert got.get(1, ("long", 500_000))[:2] == ("long", 500_000)


def test_crowded_keys_have_gapless_slots(spark, monkeypatch):
    from corpusmill.llm import sharding

    monkeypatch.setattr(sharding, "CROWD", 5)
    rows = [(None, f"t{i}") for i in range(60)] + [(None, "same")] * 20 + [(i, "x") for i in range(50)]
    got = shard_manifest(docs(spark, rows)).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == 130 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_written_tables_can_be_removed(spark):
    from corpusmill.llm import shared

    df = shared.materialize(spark.range(3).toDF("a"), "some")
    assert df.count() == 3 and shared.remove_written(spark) and not shared.remove_written(spark)
    assert shared.materialize(spark.range(2).toDF("a"), "more").count() == 2
