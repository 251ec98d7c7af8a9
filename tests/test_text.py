import hashlib

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import score


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(expr).first()[0]


@pytest.mark.parametrize("text, n", [("", 0), ("  a  b\n", 2), ("a b", 2)])
def test_word_count(spark, text, n):
    assert one(spark, tx.word_count(F.col("t")), t=text) == n


@pytest.mark.parametrize("text, ok", [('{"a": 1}', True), ('{"a": 1} x', False), ("", False), ("{'a': 1}", False)])
def test_strict_json(spark, text, ok):
    assert one(spark, tx.strict_json(F.col("t")).isNotNull(), t=text) is ok


@pytest.mark.parametrize("text", ["<think>hm</think>\n{\"k\": 2}", "```json\n{\"k\": 2}\n```", "say {\"k\": 2} so"])
def test_json_inside_other_text(spark, text):
    parsed = tx.extract_json(F.regexp_replace("t", r"(?s)<think>.*?</think>", ""))
    assert one(spark, tx.json_field(parsed, "k", "int"), t=text) == 2


def test_bucket_is_the_128_bit_md5_modulo_100(spark):
    for text in ("exp:1", "exp:77", ""):
        assert one(spark, tx.bucket100(F.col("t")), t=text) == int(hashlib.md5(text.encode()).hexdigest(), 16) % 100


@pytest.mark.parametrize("pred, gold, joined, token", [([], [], 1.0, 1.0), (["a"], [], 0.0, 0.0), (["a"], ["a"], 1.0, 1.0), (["a", "b"], ["a", "c"], 0.8, 0.5), ([], ["ab"], 0.0, 0.0)])
def test_list_distances(spark, pred, gold, joined, token):
    df = spark.createDataFrame([(pred, gold)], "p array<string>, g array<string>")
    row = df.select(tx.joined_distance_score(F.col("p"), F.col("g")), tx.token_distance_score(F.col("p"), F.col("g"))).first()
    assert tuple(row) == pytest.approx((joined, token))


def test_list_distance_of_many_distinct_items(spark):
    df = spark.createDataFrame([([f"t{i}" for i in range(600)], [f"t{i if i < 300 else i + 512}" for i in range(600)])], "p array<string>, g array<string>")
    assert df.select(tx.token_distance_score(F.col("p"), F.col("g"))).first()[0] == pytest.approx(0.5)


@pytest.mark.parametrize("base, text, want", [("low", "this is an issue", "medium"), ("medium", "URGENT", "high"), ("high", "asap", "high"), ("low", "fraud", "critical"), ("low", "hello", "low")])
def test_urgency(spark, base, text, want):
    assert one(spark, tx.escalated_urgency(F.col("b"), F.col("t")), b=base, t=text) == want


@pytest.mark.parametrize(
    "text, want",
    [("fine", 0.5), ("mail a@b.com", 0.0), ("refund $600.00", 0.2), ("there is fraud", 0.0), ("fraud, will escalate", 0.5), ("you should call a lawyer", 0.2), ("your order has been shipped", 0.3), ("a@b.com 123-45-6789 fraud $900", -1.0)],
)
def test_policy_reward(spark, text, want):
    assert one(spark, score.policy_reward(F.col("t")), t=text) == pytest.approx(want)


def test_anonymize_keeps_business_ids(spark):
    df = spark.createDataFrame([("write a@b.com about ORD-123-45-6789 or 123-45-6789",), (None,)], "t string")
    assert [r["t"] for r in score.anonymize(df, ["t"]).collect()] == ["write [EMAIL_REDACTED] about ORD-123-45-6789 or [SSN_REDACTED]".replace("ORD-123-45-6789", "ORD-123-45-6789"), None]


def test_format_and_tool_rewards(spark):
    good = '{"intent":"a","urgency":"low","workflow_steps":["x"],"tools_required":[],"reasoning":"","response":"y"}'
    calls = '{"tool_calls":[{"name":"refund_processing_api","parameters":{"order_id":1}},{"name":"none","parameters":{}}]}'
    for text, fmt, tool in ((good, 1.0, 0.8), ('{"a":1}', 0.5, 0.0), ("[1]", 0.0, 0.0), ("no", 0.0, 0.0), (calls, 0.5, 0.375)):
        assert one(spark, score.format_reward(F.col("t")), t=text) == fmt
        assert one(spark, score.tool_reward(F.col("t")), t=text) == pytest.approx(tool)
