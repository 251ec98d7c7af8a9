import math

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import convert, evaluate, mix, quality
from corpusmill.plans.registry import ORACLES, QUERIES
from corpusmill.sources import readers

SF = "/root/testdata/sf0.001"


def test_every_query_runs_and_has_unique_columns(spark):
    for name in ("quality_by_lang", "dedup_semantic_greedy", "mix_composition", "gold_audit", "time_profile"):
        df = QUERIES[name](spark, SF)
        assert len(set(df.columns)) == len(df.columns)
        df.collect()


def test_only_stateful_scans_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"dedup_semantic_greedy"}


def test_dedup_exact_keeps_first_and_is_idempotent(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "b")], "doc_id long, text string")
    once = quality.dedup_exact(df)
    assert sorted(r["doc_id"] for r in once.collect()) == [1, 2, 5]
    assert quality.dedup_exact(once).count() == 3
    assert quality.dedup_exact(df.drop("text")).count() == 5


def test_filters_without_their_column_do_nothing(spark):
    df = spark.range(3)
    assert quality.filter_length(df).count() == quality.filter_at_least(df, "confidence", 1).count() == 3


def test_greedy_semantic_dedup(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.99, 0.1]), (3, [0.0, 1.0]), (4, [0.1, 0.99])]
    kept = quality.dedup_semantic(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95)
    assert sorted(r["vec_id"] for r in kept.collect()) == [1, 3]


def test_mix_repeats_small_sources_and_cuts_large_ones(spark):
    df = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(20)], "doc_id long, source string")
    got = mix.mix_sources(df, {"a": 0.5, "b": 0.5, "c": 0.0}, 14).groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("d"), F.max("copy").alias("m")).collect()
    assert {r["source"]: (r["n"], r["d"], r["m"]) for r in got} == {"a": (7, 3, 2), "b": (7, 7, 0)}
    with pytest.raises(ValueError):
        mix.mix_sources(df, {"a": 0}, 3)


def test_split_is_disjoint_and_whole(spark):
    got = mix.split(spark.range(101).withColumnRenamed("id", "doc_id"), 0.9, key="doc_id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 90, "eval": 11}


def test_stratified_sample_has_every_stratum(spark):
    df = spark.createDataFrame([(i, "rare" if i == 0 else "common") for i in range(100)], "doc_id long, s string")
    got = mix.stratified_sample(df, 10, column="s", key="doc_id").collect()
    assert len(got) == 10 and {r["s"] for r in got} == {"rare", "common"}


def test_converters(spark):
    marked = spark.createDataFrame([("SYSTEM: s\nUSER: hi\nASSISTANT: yo\nFUNCTION_RESPONSE: {}",), ("nothing",)], "chat string")
    rows = [[(m["role"], m["content"]) for m in r["messages"]] for r in convert.converter("marked_text")(marked).collect()]
    assert rows[0] == [("system", "s"), ("user", "hi"), ("assistant", "yo"), ("tool", "{}")] and len(rows[1]) == 3
    turns = spark.createDataFrame([([("human", "q"), ("gpt", "a")],), ([],)], "conversations array<struct<from:string,value:string>>")
    rows = [[m["role"] for m in r["messages"]] for r in convert.converter("turns")(turns).collect()]
    assert rows == [["system", "user", "assistant"]] * 2
    calls = spark.createDataFrame([("q", "[]", "broken")], "query string, tools string, answers string")
    assert convert.converter("function_calls")(calls).first()["messages"][2]["content"] == "No tool call needed."
    with pytest.raises(ValueError):
        convert.converter("unknown")


def test_f1_and_t_test(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "b"), ("c", "b")], "p string, g string")
    row = evaluate.f1_summary(df, "p", "g").first()
    assert row["micro_f1"] == 0.5 and row["macro_f1"] == pytest.approx((2 / 3 + 0.5 + 0) / 3)
    t, p = evaluate.t_statistic({"n": 10, "mean": 1.0, "variance": 1.0}, {"n": 10, "mean": 2.0, "variance": 1.0})
    assert t == pytest.approx(-math.sqrt(5)) and p == pytest.approx(0.038250, abs=1e-5)
    assert evaluate.t_statistic({"n": 4, "mean": 1, "variance": 1}, {"n": 9, "mean": 1, "variance": 1}) is None


def test_label_fixes(spark):
    gold = spark.createDataFrame([(1, "x", None), (2, "y", "z"), (3, "w", None)], "id long, label string, second string")
    fixes = spark.createDataFrame([(1, "relabel", "n"), (2, "add_secondary", "m"), (3, "add_secondary", "k")], "id long, action string, new_label string")
    got = {r["id"]: (r["label"], r["second"]) for r in evaluate.apply_fixes(gold, fixes, "id", "label", "second").collect()}
    assert got == {1: ("n", None), 2: ("y", "z"), 3: ("w", "k")}


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"body": "x", "n": 1}\n\nnot json\n{"body": "y", "n": 2}\n')
    (tmp_path / "b.csv").write_text("message;answer\nhello;there\n")
    (tmp_path / "c.jsonl").write_text('{"other": 1}\n')
    got = readers.read_folder(spark, [str(tmp_path / n) for n in ("b.csv", "a.jsonl", "c.jsonl")])
    assert sorted(r["customer_message"] for r in got.collect()) == ["hello", "x", "y"]
    (tmp_path / "bad.jsonl").write_text("no\n")
    with pytest.raises(ValueError):
        readers.read_jsonl(spark, str(tmp_path / "bad.jsonl"))
    registry = readers.Registry()
    registry.load_config({"docs": {"type": "jsonl", "path": str(tmp_path / "a.jsonl")}})
    assert registry.get(spark, "docs").count() == 2 and registry.names() == ["docs"]
    with pytest.raises(KeyError):
        registry.get(spark, "none")
    with pytest.raises(ValueError):
        registry.register("x", "nokind")


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "a long, b string")
    readers.write_jsonl(df, str(tmp_path / "out"))
    assert sorted(map(tuple, readers.read_jsonl(spark, str(tmp_path / "out"), "a long, b string").collect())) == [(1, "é"), (2, None)]


def test_enrichment_pairs_and_calls(spark):
    kind = "array<struct<role:string,content:string>>"
    rows = [([("user", "q"), ("assistant", '{"intent":"a","response":"r"}')], [("user", "q"), ("assistant", "other")], ["s"] * 8, ["vision_api", "nothing"], "odd")]
    df = spark.createDataFrame(rows, f"m {kind}, r {kind}, steps array<string>, tools array<string>, urgency string")
    out = df.select(convert.apply_enrichment(F.col("m"), F.col("steps"), F.col("tools"), F.col("urgency")).alias("m"), convert.preferred_turns(F.col("m"), F.col("r")).alias("p"), convert.preferred_turns(F.col("m"), F.col("m")).alias("none")).first()
    import json

    body = json.loads(out["m"][1]["content"])
    assert (len(body["workflow_steps"]), body["tools_required"], body["urgency"], body["intent"]) == (6, ["vision_api"], "medium", "a")
    assert out["none"] is None and [m["role"] for m in out["p"]["prompt"]] == ["user"] and out["p"]["rejected"][0]["content"] == "other"
    calls = [([("assistant", '{"name":"x"}'), ("tool", "1")],), ([("assistant", '{"name":"x"}')],), ([("user", "x")],)]
    got = [r[0] for r in spark.createDataFrame(calls, f"m {kind}").select(convert.tool_calls_answered(F.col("m"))).collect()]
    assert got == [True, False, True]


def test_costs_and_mock_calls(spark):
    from corpusmill.operators import score

    df = spark.createDataFrame([("m", 1000, 500, "order_lookup_api", ["order_id"]), ("x", 1000, 500, "none", []), ("x", 0, 0, "policy_engine", ["context"])], "m string, i long, o long, n string, g array<string>")
    rows = df.select(score.cost(F.col("i"), F.col("o"), F.col("m"), {"m": (2.0, 4.0)}).alias("c"), score.execute_call(F.col("n"), F.col("g")).alias("e")).collect()
    assert [round(r["c"], 6) for r in rows] == [0.004, 0.0025, 0.0]
    assert [(r["e"]["status"], r["e"]["missing"]) for r in rows] == [("success", []), ("unknown_tool", []), ("missing_parameters", ["policy_type"])]


def test_custom_fields_of_every_key_are_reported(spark, tmp_path):
    rows = [('{"k": "a", "other": " "}',), ('{"k": "", "other": "x"}',), ('{"other": "y"}',)]
    spark.createDataFrame(rows, "props string").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in QUERIES["custom_field_fill"](spark, str(tmp_path)).collect())
    assert got == [("k", 2, 1), ("other", 3, 2)]
