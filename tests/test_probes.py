"""Inputs that once gave wrong answers, and operators that write or raise."""

import json

import pytest
from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators import convert, evaluate, mix, order, profile, quality, score
from corpusmill.sources import readers

MESSAGES = "array<struct<role:string,content:string>>"


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr).first()[0]


@pytest.mark.parametrize("text", ['{"a":1}],[1', '{"a":1}]', "1}", '1,"b":2', "1,2", '{"a":1} x'])
def test_json_must_be_the_whole_text(spark, text):
    assert one(spark, tx.strict_json(F.col("t")), text) is None


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"tools_required":[{"name":"order_lookup_api","parameters":{"order_id":1}}]}', 1.0),
        ('{"tool_calls":[{"function":{"name":"order_lookup_api","arguments":"{\\"order_id\\": 1}"}}]}', 1.0),
        ('{"tool_calls":[{"name":"order_lookup_api","arguments":{"order_id":1}}]}', 1.0),
        ('{"tool_calls":[{"name":"order_lookup_api","arguments":"no json"}]}', 0.5),
        ('{"tools_required":[5, "vision_api"]}', 0.5),
        ('{"tools_required":[]}', 0.8),
        ("[]", 0.0),
    ],
)
def test_tool_calls_of_every_form(spark, text, want):
    assert one(spark, score.tool_reward(F.col("t")), text) == pytest.approx(want)


def test_rewards_are_the_single_scores(spark):
    text = '{"tools_required":["vision_api"],"response":"You will have it, dude. a@b.com"}'
    df = spark.createDataFrame([(text,), ("there is fraud",)], "t string")
    got = score.rewards(df, "t").select("policy", "quality", "format", "tool_accuracy", "composite").collect()
    want = df.select(score.policy_reward(F.col("t")), score.quality_reward(F.col("t")), score.format_reward(F.col("t")), score.tool_reward(F.col("t"))).collect()
    assert [tuple(r)[:4] for r in got] == [tuple(r) for r in want]
    assert got[0]["composite"] == pytest.approx(sum(got[0][n] * w for n, w in score.WEIGHTS.items()))
    with pytest.warns(UserWarning):
        score.rewards(df, "t", weights={"policy": 0.5})


def test_broken_documents_are_counted(spark, tmp_path):
    for name, text in (("a", '{"x": 1, "y": {"z": "q"}}'), ("b", "{broken"), ("c", '{"x": 2}\n'), ("d", '{"x": 1} {"x": 2}')):
        (tmp_path / f"{name}.json").write_text(text)
    rows, broken = readers.read_documents(spark, str(tmp_path))
    assert broken == 2 and sorted((r["x"], r["source_file"], r["y"] and r["y"]["z"]) for r in rows.collect()) == [(1, "a.json", "q"), (2, "c.json", None)]
    rows, broken = readers.read_documents(spark, str(tmp_path), "x long")
    assert broken == 2 and sorted(r["x"] for r in rows.collect()) == [1, 2]
    rows, broken = readers.read_documents(spark, str(tmp_path), "x long", sample=2)
    assert rows.count() + broken == 2


def test_turns_of_both_forms(spark):
    rows = [(1, [("user", "q"), ("assistant", "a")], "t"), (2, None, "only text"), (3, [], None)]
    df = spark.createDataFrame(rows, f"id long, conversations {MESSAGES}, text string")
    got = {r["id"]: [(m["role"], m["content"]) for m in r["messages"]][1:] for r in convert.convert_rows(df, "t1", ["id"]).collect()}
    assert got == {1: [("user", "q"), ("assistant", "a")], 2: [("user", "only text"), ("assistant", "")], 3: [("user", ""), ("assistant", "")]}
    chain = spark.createDataFrame([([("observation", "o")], "q"), (None, "q"), (None, None)], "conversations array<struct<from:string,value:string>>, query string")
    got = [[(m["role"], m["content"]) for m in r["messages"]][1:] for r in convert.converter("toolace")(chain).collect()]
    assert got[0] == [("tool", "o")] and got[1][0] == ("user", "q") and json.loads(got[2][0][1]) == {"conversations": None, "query": None}
    # an observation is a tool's turn in tool chains only
    assert convert.converter("hermes")(chain).first()["messages"][1]["role"] == "observation"


def test_label_numbers(spark):
    df = spark.createDataFrame([(12, "x"), (42, "x"), (500, "x")], "intent long, text string")
    assert [r["intent_out"] for r in convert.from_scope_labels(df).collect()] == ["fraud_report", "general_inquiry", "general_inquiry"]
    assert [r["intent"] for r in convert.service_labels(df).collect()] == [12, 42]
    names = df.select(F.lit("weather").alias("intent")).union(df.select(F.lit("cancel").alias("intent")))
    assert {r["intent"] for r in convert.service_labels(names).collect()} == {"cancel"}
    assert len(domain.SCOPE_NAMES) == 151 and len(domain.BANKING_INTENT) == 77


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b"), (3, "b")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in quality.dedup_exact(df).collect()) == [(0, "b"), (1, "a")]
    chats = spark.createDataFrame([(1, [("user", "x")]), (1, [("user", "x")])], f"conv_id long, messages {MESSAGES}")
    assert convert.dedup_messages(chats).count() == 1
    assert quality.dedup_exact(df.limit(0)).count() == 0


def test_semantic_dedup_goes_by_the_angle(spark):
    rows = [(1, [10.0, 0.0]), (2, [0.5, 10.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, 0.01])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for f in (quality.dedup_semantic, quality.dedup_semantic_neighbours):
        assert sorted(r["vec_id"] for r in f(df).collect()) == [1, 2]
    far = spark.createDataFrame([(1, [1.0]), (2, [1.0]), (5, [1.0])], "vec_id long, embedding array<double>")
    assert sorted(r["vec_id"] for r in quality.dedup_semantic_neighbours(far, window=2).collect()) == [1, 5]


@pytest.mark.parametrize("text, want", [("\u0001 a@b.com", "\u0001 [EMAIL_REDACTED]"), ("\u0001ORD\u0002x\u0003 123-45-6789", "\u0001ORD\u0002x\u0003 [SSN_REDACTED]"), ("tkt-9 a@b.com ORD-1", "tkt-9 [EMAIL_REDACTED] ORD-1"), ("ORD-1", "ORD-1"), ("", "")])
def test_no_character_shields_personal_data(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert score.anonymize(df, ["t", "absent"]).first()["t"] == want


def test_personal_data_outside_the_response_is_flagged(spark):
    answer = {"intent": "a", "urgency": "low", "workflow_steps": ["x"], "tools_required": ["y"], "reasoning": "mail a@b.com and c@d.com", "response": "fine"}
    df = spark.createDataFrame([(json.dumps(answer),)], "t string")
    row = score.postprocess(df, "t").first()
    assert row["flags"] == ["pii:email", "pii:email"] and row["escalate"] and not row["safe"] and row["response"] == "fine"


def test_mock_calls(spark):
    calls = '{"tool_calls":[{"name":"order_lookup_api","arguments":{"order_id":"7"}},{"name":"order_lookup_api","arguments":{"order_id":"8"}},{"name":"order_lookup_api"},{"name":"x"}]}'
    mocks = [("order_lookup_api", {"order_id": "7"}, {"status": "lost"})]
    got = one(spark, score.execute_calls(score.parse_tool_calls(tx.strict_json(F.col("t"))), mocks), calls)
    assert [c["success"] for c in got] == [True, True, False, False]
    assert json.loads(got[0]["response"]) == {"status": "lost"} and json.loads(got[1]["response"])["order_id"] == "8"
    assert got[2]["error"] == "Missing required parameters: order_id" and got[3]["error"] == "Unknown tool: x"


def test_contracts(spark):
    df = spark.createDataFrame([(1, "hello", "world"), (2, "hi", "world"), (3, None, "world")], "id long, customer_message string, agent_response string")
    report, errors = quality.validate_dataset(df, "raw_ticket", "id")
    assert tuple(report.first()) == (3, 1, 2, pytest.approx(1 / 3))
    assert sorted(map(tuple, errors.collect())) == [(2, "customer_message: too short"), (3, "customer_message: missing")]
    assert quality.validate_dataset(df, "raw_ticket", "id", first=1)[0].first()["valid_ratio"] == 1.0
    assert tuple(quality.validate_dataset(df.limit(0), "raw_ticket", "id")[0].first()) == (0, 0, 0, 0.0)
    with pytest.raises(ValueError, match="id 2"):
        quality.validate_dataset(df, "raw_ticket", "id", raise_on_error=True)
    pairs = spark.createDataFrame([(1, [("user", "q")], [("assistant", "a")], [("assistant", "a")])], f"id long, prompt {MESSAGES}, chosen {MESSAGES}, rejected {MESSAGES}")
    assert [r["error"] for r in quality.validate_dataset(pairs, "preference_pair", "id")[1].collect()] == ["rejected: same as chosen"]
    with pytest.raises(ValueError):
        convert.build_pairs(pairs, "none")


def test_filters_by_name(spark):
    df = spark.createDataFrame([(i, "w " * (i + 5), "a") for i in range(10)], "doc_id long, text string, intent string")
    with pytest.warns(UserWarning):
        left, report = quality.apply_all(df, {"filter_length": {"least": 10}, "no_filter": None, "balance_intents": {"share": 0.2, "key": "doc_id"}})
    assert left.count() == 1 and [(r["stage"], r["before"], r["after"], r["removed"]) for r in report.orderBy("i").collect()] == [("filter_length", 10, 5, 5), ("balance_intents", 5, 1, 4)]


def test_cuts_of_classes(spark):
    rows = [(i, None if i % 5 == 0 else "a" if i % 5 < 4 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, c string")
    limits = spark.createDataFrame([(None, 40, 7), ("a", 120, 0), ("b", 40, 90)], "class string, n long, cap long")
    got = order.heads(df, "c", limits, "id", 3).collect()
    want = sorted((i for i, c in rows if c is None), key=lambda i: __import__("hashlib").md5(f"{i}:3".encode()).hexdigest())[:7]
    assert sorted(r["id"] for r in got if r["c"] is None) == sorted(want)
    assert sum(r["c"] == "b" for r in got) == 40 and not any(r["c"] == "a" for r in got)
    assert {r["split"] for r in mix.split(df.limit(0), 0.5, key="id").collect()} == set()
    assert mix.stratified_sample(df, 0, key="id").count() == 0


def test_upper_median(spark):
    for values in ([5], [1, 2], [3, 3, 9000], list(range(0, 5000, 7))):
        df = spark.createDataFrame([(v,) for v in values], "n int")
        assert profile.upper_median(df, "n").first()[0] == sorted(values)[len(values) // 2]
    assert profile.upper_median(spark.createDataFrame([(None,)], "n int"), "n").first()[0] is None


def test_gold_checkpoint_reports_and_training_set(spark, tmp_path):
    path = str(tmp_path / "gold.jsonl")
    assert readers.read_gold(spark, path).count() == 5 and readers.read_gold(spark, path).count() == 5
    (tmp_path / "own.jsonl").write_text('{"ticket_id": "x", "gold_intent": "y"}\nbroken\n\n')
    assert [r["gold_intent"] for r in readers.read_gold(spark, str(tmp_path / "own.jsonl")).collect()] == ["y"]
    df, done = spark.range(5), str(tmp_path / "done")
    assert readers.resume(df, done, "id").count() == 5
    readers.append_checkpoint(df.where("id < 2"), done)
    readers.append_checkpoint(df.where("id = 4"), done)
    assert sorted(r["id"] for r in readers.resume(df, done, "id").collect()) == [2, 3]
    train = str(tmp_path / "train")
    for _ in range(2):
        readers.write_train(df.withColumn("part", F.col("id") % 2), train, by=["part"])
    assert spark.read.parquet(train).count() == 5
    readers.write_train(df, train, mode="ignore")
    assert "part" in spark.read.parquet(train).columns
    text = readers.markdown_report(4, {"Languages": spark.createDataFrame([("en", 3), ("de", 1)], "value string, n long")}, {"Use": {"all": 4}}, readers.advice(4, 1, 2, 1, {"en": 3, "de": 1}))
    assert "| en | 3 | 75.0% |" in text and "1. Filter automated tickets: 1 (25.0%)" in text and "Main language: en (75.0%)" in text
    readers.write_report(spark.createDataFrame([("s", "m", 1.5)], "stage string, metric string, value double"), str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"s": {"m": 1.5}}


def test_folder_query_and_splits(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"body": "x"}\n')
    (tmp_path / "b.csv").write_text("message,answer\nhello,there\n")
    (tmp_path / "c.json").write_text("no json\n")
    assert sorted(r["customer_message"] for r in readers.read_folder(spark, str(tmp_path)).collect()) == ["hello", "x"]
    parts = readers.read_splits(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "a.jsonl"))
    assert set(parts) == {"train", "eval"} and parts["eval"].count() == 1
    spark.range(2).createOrReplaceTempView("two_rows")
    assert readers.read_query(spark, "SELECT id AS text FROM two_rows").columns == ["customer_message"]
    with pytest.raises(ValueError):
        readers.read_query(spark, "SELECT id FROM two_rows WHERE id > 5")
    assert readers.complete_rows(spark.range(2), ["id", "none"]).count() == 0
    registry = readers.Registry()
    with pytest.raises(ValueError):
        registry.load_source(spark, "x", {"loader": "none"})


def test_experiments_and_router(spark, tmp_path):
    runs = evaluate.Experiments()
    with pytest.raises(ValueError):
        runs.create("e", ["a"], {"a": 0.5})
    with pytest.raises(ValueError):
        runs.create("e", ["a", "c"], {"a": 0.5, "b": 0.5})
    runs.create("e", ["a", "b"], {"a": 0.5, "b": 0.5})
    with pytest.raises(KeyError):
        runs.assign("none", F.lit("u"))
    df = spark.range(50).withColumn("variant", runs.assign("e", F.col("id")))
    path = str(tmp_path / "facts")
    for _ in range(2):
        evaluate.record_metrics(df.select(F.lit("e").alias("experiment"), "variant", F.lit("m").alias("metric"), F.col("id").alias("value")), path)
    got = evaluate.experiment_results(spark.read.parquet(path)).collect()
    assert sum(r["count"] for r in got) == 100 and {r["variant"] for r in got} == {"a", "b"}


def test_small_functions(spark):
    assert score.training_time(4000, 1000, 4, 2) == {"total_steps": 375, "steps_per_epoch": 125, "total_tokens": 1536000, "estimated_throughput_tokens_sec": 3000, "estimated_hours": 0.14}
    assert "Acme" in domain.system_prompt("Acme", ("a", "b")) and "a, b" in domain.system_prompt("Acme", ("a", "b"))
    assert all(abs(sum(m.values()) - 1) < 0.01 for m in domain.DATA_MIXES.values())
    assert one(spark, tx.clean_response(F.col("t")), ' "say \\"x\\"\\nnow" ') == 'say "x"\nnow'
    pref = spark.createDataFrame([(None, [("assistant", "a")], None)], f"prompt {MESSAGES}, chosen {MESSAGES}, rejected {MESSAGES}")
    assert [len(x) for x in convert.convert_rows(pref, "preference").first()] == [0, 1, 0]
    with pytest.raises(ValueError):
        evaluate.run_suite(pref, "x", "none")
    assert evaluate.run_suites(pref, "x", ["none"]).first()["error"].startswith("unknown suite")
