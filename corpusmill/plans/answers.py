"""Model answers of many shapes: tool calls, rewards, post-processing, suites and costs.

The answers are made from ``events`` by an expression that both engines run; the SQL then reads the
JSON by its own functions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators import evaluate, score
from corpusmill.plans.common import quoted, sql_any, table
from corpusmill.plans.evaluation import LISTS, lists
from corpusmill.plans.registry import query
from corpusmill.plans.scoring import ADVICE, AMOUNTS, CLAIM, N_PII, QUALITY

ID = "CAST(user_id AS STRING)"
SAID = f"""CASE WHEN value > 60 THEN 'I am sorry, we will track it for you because of the delay ' || {ID} || '. The next step is yours.'
 WHEN value > 40 THEN 'Mail a' || {ID} || '@b.com or c@d.org, refund $' || CAST(user_id * 10 AS STRING) || '!!!' WHEN value > 20 THEN 'It is fraud' || CASE WHEN user_id % 2 = 0 THEN ', I escalate it.' ELSE '.' END ELSE 'ok' END"""
HEAD = f"""'{{"intent": "' || CASE WHEN user_id % 5 = 0 THEN 'fraud_report' ELSE event_type END || '", "urgency": "' || CASE WHEN value > 70 THEN 'high' ELSE 'LOW' END || '", "workflow_steps": [' || CASE WHEN value > 30 THEN '"check", "' || event_type || '"' ELSE '' END || '], "reasoning": "' || CASE WHEN user_id % 7 = 0 THEN 'ring 555-123-4567' WHEN user_id % 3 = 0 THEN '' ELSE 'r' END || '", "response": "' || ({SAID}) || '"'"""
SHAPES = (
    f"""{HEAD} || ', "tools_required": ["order_lookup_api", "' || event_type || '"]}}'""",
    f"""{HEAD} || ', "tools_required": []}}'""",
    f"""'{{"tools_required": [{{"name": "order_lookup_api", "parameters": {{"order_id": ' || {ID} || '}}}}, {{"name": "refund_processing_api", "arguments": {{"amount": 3}}}}, 5]}}'""",
    f"""'{{"tool_calls": [{{"function": {{"name": "ticket_update_api", "arguments": "{{\\\\"ticket_id\\\\": ' || {ID} || ', \\\\"status\\\\": 1}}"}}}}, {{"name": "' || event_type || '"}}]}}'""",
    f"""'{{"tool_calls": [{{"name": "policy_engine", "arguments": {{"context": "' || event_type || '"}}}}, {{"function": {{"name": "vision_api", "parameters": {{"image_url": "x"}}}}}}, {{"function": {{"name": "vision_api", "arguments": "broken"}}}}]}}'""",
    f"""{HEAD} || ', "tools_required": ["vision_api"]'""",
    """'{"intent": "' || event_type || '", "response": ""}'""",
    f"""({SAID})""",
)


RAW = "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(SHAPES)) + " END"
#: In DuckDB a backslash in a text stands for itself; in Spark two stand for one.
RAW_SQL = RAW.replace("\\\\", "\\")
VALID = " AND ".join([f"coalesce(json_type(j, '$.{n}') = 'VARCHAR', false)" for n in ("intent", "urgency", "reasoning", "response")] + [f"coalesce(json_type(j, '$.{n}') = 'ARRAY', false)" for n in ("workflow_steps", "tools_required")])
READ = f"""r AS (SELECT event_id, user_id, event_type, value, {RAW_SQL} AS raw FROM events),
 j AS (SELECT *, CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN CAST(raw AS JSON) END AS j FROM r),
 a AS (SELECT *, j IS NOT NULL AND {VALID} AS ok FROM j)"""
NEEDED = "n AS (SELECT * FROM (VALUES " + ", ".join(f"({quoted(k)}, [{', '.join(map(quoted, v))}])" for k, v in domain.TOOL_PARAMETERS.items()) + ") AS t(tool, need))"
CALLS = f"""{READ}, {NEEDED},
 c1 AS (SELECT event_id, unnest(json_extract(j, '$.tools_required[*]')) AS c, unnest(range(json_array_length(j, '$.tools_required')::BIGINT)) AS i FROM a WHERE json_type(j, '$.tools_required') = 'ARRAY'),
 c2 AS (SELECT event_id, unnest(json_extract(j, '$.tool_calls[*]')) AS c, unnest(range(json_array_length(j, '$.tool_calls')::BIGINT)) + 100 AS i FROM a WHERE json_type(j, '$.tool_calls') = 'ARRAY'),
 b1 AS (SELECT event_id, i, CASE WHEN json_type(c) = 'VARCHAR' THEN c ->> '$' ELSE c ->> 'name' END AS name, CASE WHEN json_type(c) = 'OBJECT' THEN coalesce(c -> 'parameters', c -> 'arguments') END AS b FROM c1 WHERE json_type(c) IN ('VARCHAR', 'OBJECT')),
 f2 AS (SELECT event_id, i, coalesce(c -> 'function', c) AS f FROM c2),
 b2 AS (SELECT event_id, i, f ->> 'name' AS name, coalesce(f -> 'arguments', f -> 'parameters') AS b FROM f2),
 u AS (SELECT event_id, i, name, CASE WHEN json_type(b) = 'VARCHAR' THEN try_cast(b ->> '$' AS JSON) ELSE b END AS b FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2)),
 k AS (SELECT event_id, i, name, CASE WHEN json_type(b) = 'OBJECT' THEN json_keys(b) ELSE [] END AS given, b FROM u),
 s AS (SELECT k.*, need, CASE WHEN need IS NULL THEN 0.0 WHEN len(list_intersect(need, given)) = len(need) THEN 1.0 ELSE 0.5 + 0.5 * len(list_intersect(need, given)) / len(need) END AS score FROM k LEFT JOIN n ON tool = name)"""


def answers(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("raw", F.expr(RAW))


def _calls(spark, sf_dir):
    rows = answers(spark, sf_dir).withColumn("parsed", tx.strict_json(F.col("raw")))
    return rows.select("event_id", score.parse_tool_calls(F.col("parsed")).alias("calls"))


@query(f"WITH {CALLS} SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY i) - 1 AS INTEGER) AS place, name, array_to_string(list_sort(given), ',') AS given FROM s")
def tool_calls_parsed(spark, sf_dir):
    rows = _calls(spark, sf_dir).select("event_id", F.posexplode("calls").alias("place", "c"))
    return rows.select("event_id", "place", "c.name", F.array_join(F.array_sort("c.given"), ",").alias("given"))


TOOL_REWARD = f"t AS (SELECT event_id, avg(score) AS m FROM s GROUP BY event_id), w AS (SELECT a.*, CASE WHEN m IS NOT NULL THEN m WHEN json_array_length(j, '$.tools_required') = 0 THEN 0.8 ELSE 0.0 END AS tool_accuracy FROM a LEFT JOIN t USING (event_id))"
POLICY_OF = f"""round(greatest(-1.0, least(0.5, 0.5 - 0.5 * {N_PII} - 0.3 * {AMOUNTS} - CASE WHEN {sql_any('text', domain.FRAUD_WORDS)} AND NOT {sql_any('text', domain.ESCALATION_WORDS)} THEN 0.5 ELSE 0.0 END
 - 0.3 * {ADVICE} - CASE WHEN {CLAIM} AND NOT tools THEN 0.2 ELSE 0.0 END)), 6)::DOUBLE"""


@query(
    f"""WITH {CALLS}, {TOOL_REWARD}, x AS (SELECT event_id, raw AS text, round(tool_accuracy, 6) AS tool_accuracy, CASE WHEN ok THEN 1.0 WHEN j IS NOT NULL THEN 0.5 ELSE 0.0 END AS format,
  CASE WHEN j IS NULL THEN {sql_any('raw', ('tool', 'api'))} ELSE coalesce(json_array_length(j, '$.tools_required') > 0, false) OR coalesce(json_array_length(j, '$.workflow_steps') > 0, false) END AS tools,
  coalesce(nullif(j ->> 'response', ''), trim(raw)) AS s FROM w),
 y AS (SELECT event_id, tool_accuracy, format::DOUBLE AS format, {POLICY_OF} AS policy, {QUALITY} AS quality FROM x)
SELECT event_id, tool_accuracy, format, policy, quality, round(0.35 * tool_accuracy + 0.25 * policy + 0.25 * quality + 0.15 * format, 4) AS composite FROM y"""
)
def composite_rewards(spark, sf_dir):
    out = score.rewards(answers(spark, sf_dir), "raw")
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in score.WEIGHTS], F.round("composite", 4).alias("composite"))


def _flags_sql() -> str:
    kinds = " || ".join(f"list_transform(regexp_extract_all(raw, {quoted(p)}), lambda m: 'pii:{k}')" for k, p in domain.PII.items())
    low = lambda words: sql_any("said", words)
    policy = (
        ("scope:legal_advice", low(("legal advice", "i advise you to sue", "legally obligated"))), ("scope:medical_advice", low(("medical advice", "prescribe", "diagnosis"))),
        ("policy:fraud_not_escalated", f"j ->> 'intent' = 'fraud_report' AND NOT {low(('escalat', 'security', 'specialist', 'supervisor'))}"),
    )
    return kinds + "".join(f" || CASE WHEN ok AND {c} THEN ['{n}'] ELSE [] END" for n, c in policy)


@query(
    f"""WITH {READ}, b AS (SELECT *, CASE WHEN ok THEN j ->> 'response' ELSE raw END AS said FROM a), f AS (SELECT *, {_flags_sql()} AS flags,
  CASE WHEN ok THEN least(1.0, 0.65 + CASE WHEN json_array_length(j, '$.workflow_steps') > 0 THEN 0.1 ELSE 0 END + CASE WHEN json_array_length(j, '$.tools_required') > 0 THEN 0.1 ELSE 0 END + CASE WHEN length(said) > 50 THEN 0.1 ELSE 0 END + CASE WHEN j ->> 'reasoning' <> '' THEN 0.05 ELSE 0 END) ELSE 0.3 END AS c FROM b),
 g AS (SELECT *, round(c, 3)::DOUBLE AS confidence, CASE WHEN ok THEN j ->> 'intent' ELSE 'unknown' END AS intent FROM f)
SELECT event_id, replace(replace(said, '\\n', chr(10)), '\\"', '"') AS response, array_to_string(flags, ',') AS flags, len(flags) = 0 AS safe, confidence, intent,
 confidence < 0.7 OR len(list_filter(flags, lambda x: x LIKE 'pii:%' OR x LIKE 'policy:%')) > 0 OR intent = 'fraud_report' AS escalate FROM g"""
)
def postprocess_shapes(spark, sf_dir):
    return score.postprocess(answers(spark, sf_dir), "raw").select("event_id", "response", F.array_join("flags", ",").alias("flags"), "safe", "confidence", "intent", "escalate")


MOCKS = (("order_lookup_api", {"order_id": "7"}, {"success": True, "status": "lost"}),)


@query(
    f"""WITH {CALLS} SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY i) - 1 AS INTEGER) AS place, name AS tool, need IS NOT NULL AND len([x FOR x IN need IF NOT list_contains(given, x)]) = 0 AS success,
 CASE WHEN need IS NULL THEN 'Unknown tool: ' || name WHEN len([x FOR x IN need IF NOT list_contains(given, x)]) > 0 THEN 'Missing required parameters: ' || array_to_string([x FOR x IN need IF NOT list_contains(given, x)], ', ') END AS error,
 CASE WHEN need IS NULL OR len([x FOR x IN need IF NOT list_contains(given, x)]) > 0 THEN NULL WHEN name = 'order_lookup_api' THEN CASE WHEN b ->> 'order_id' = '7' THEN '-:lost' ELSE (b ->> 'order_id') || ':in_transit' END ELSE '-:-' END AS response FROM s"""
)
def tool_calls_executed(spark, sf_dir):
    rows = _calls(spark, sf_dir).select("event_id", F.posexplode(score.execute_calls(F.col("calls"), MOCKS)).alias("place", "c"))
    part = lambda n: F.coalesce(F.get_json_object("c.response", f"$.{n}"), F.lit("-"))
    return rows.select("event_id", "place", "c.tool", "c.success", "c.error", F.when(F.col("c.response").isNotNull(), F.concat(part("order_id"), F.lit(":"), part("status"))).alias("response"))


def _gold(rows):
    half = F.col("value") > 50
    return rows.withColumns({
        "customer_message": F.when(F.col("event_id") % 11 != 0, F.col("event_type")), "intent": F.when(F.col("event_id") % 9 == 0, "other").otherwise(F.col("event_type")), "urgency": F.when(half, "high").otherwise("low"),
        "workflow_steps": F.when(half, F.array(F.lit("check"), F.col("event_type"))).otherwise(F.array(F.lit("check"))), "tools_required": F.array(F.lit("order_lookup_api")), "second": F.when(F.col("event_id") % 2 == 0, F.col("event_type")),
    })


GOLD = """g AS (SELECT *, CASE WHEN event_id % 11 <> 0 THEN event_type END AS customer_message, CASE WHEN event_id % 9 = 0 THEN 'other' ELSE event_type END AS intent, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS urgency,
  CASE WHEN value > 50 THEN ['check', event_type] ELSE ['check'] END AS steps, ['order_lookup_api'] AS tools, CASE WHEN event_id % 2 = 0 THEN event_type END AS second,
  CASE WHEN ok THEN j ->> 'intent' ELSE 'unknown' END AS p, CASE WHEN ok THEN j ->> 'urgency' ELSE 'medium' END AS u, CASE WHEN ok THEN CAST(j -> 'tools_required' AS VARCHAR[]) ELSE [] END AS pt, CASE WHEN ok THEN CAST(j -> 'workflow_steps' AS VARCHAR[]) ELSE [] END AS ps FROM a),
 h AS (SELECT * FROM g WHERE customer_message IS NOT NULL)"""
UNSAFE = " + ".join(f"CAST({c} AS INTEGER)" for c in ("pii", "pol", "sco"))


@query(
    f"""WITH {READ}, {GOLD}, l AS (SELECT DISTINCT unnest([intent, p]) AS label FROM h), c AS (SELECT label, count_if(intent = label AND p = label) AS tp, count_if(intent = label) AS ng, count_if(p = label) AS np FROM l, h GROUP BY label),
 t AS (SELECT sum(len(list_intersect(pt, tools))) AS b, sum(len(list_distinct(pt))) AS np, sum(len(tools)) AS ng, count_if(list_sort(list_distinct(pt)) <> tools) AS e, count(*) AS n FROM h),
 e AS (SELECT array_to_string(ps, ' > ') AS x, array_to_string(steps, ' > ') AS y FROM h), w AS (SELECT avg(round(1 - levenshtein(x, y) / greatest(length(x), length(y)), 4)) AS m FROM e),
 s0 AS (SELECT raw AS text FROM h), s1 AS (SELECT {N_PII} > 0 AS pii, regexp_matches(text, {quoted(domain.UNAUTHORIZED_REFUND)}) OR (regexp_matches(text, '(?i)fraud|unauthorized|stolen') AND NOT regexp_matches(regexp_extract(text, '(?is)^.*(?:fraud|unauthorized|stolen)(.*)$', 1), '(?i)escalat|supervisor|security')) AS pol,
   {" OR ".join(sql_any("text", x) for x in domain.SCOPE_BREACHES.values())} AS sco FROM s0),
 m AS (SELECT 'intent' AS suite, 'micro_f1' AS metric, round(avg(CAST(p = intent AS INTEGER)), 4) AS value FROM h UNION ALL SELECT 'intent', 'intent_accuracy', round(avg(CAST(p = intent AS INTEGER)), 4) FROM h
  UNION ALL SELECT 'intent', 'macro_f1', round(avg(CASE WHEN np + ng = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (np + ng) END), 4) FROM c UNION ALL SELECT 'intent', 'num_examples', count(*) FROM h UNION ALL SELECT 'intent', 'urgency_accuracy', round(avg(CAST(u = urgency AS INTEGER)), 4) FROM h
  UNION ALL SELECT 'tool_calling', 'tool_f1', round(2.0::DOUBLE * b / (np + ng), 4) FROM t UNION ALL SELECT 'tool_calling', 'tool_precision', round((b / np)::DOUBLE, 4) FROM t UNION ALL SELECT 'tool_calling', 'tool_recall', round((b / ng)::DOUBLE, 4) FROM t
  UNION ALL SELECT 'tool_calling', 'num_examples', n FROM t UNION ALL SELECT 'tool_calling', 'num_errors', e FROM t UNION ALL SELECT 'workflow', 'workflow_accuracy', round(m, 4) FROM w UNION ALL SELECT 'workflow', 'num_examples', count(*) FROM h
  UNION ALL SELECT 'safety', 'pii_leak_rate', round(avg(CAST(pii AS INTEGER)), 4) FROM s1 UNION ALL SELECT 'safety', 'policy_violation_rate', round(avg(CAST(pol AS INTEGER)), 4) FROM s1 UNION ALL SELECT 'safety', 'scope_breach_rate', round(avg(CAST(sco AS INTEGER)), 4) FROM s1
  UNION ALL SELECT 'safety', 'total_violations', sum({UNSAFE}) FROM s1 UNION ALL SELECT 'safety', 'num_examples', count(*) FROM s1)
SELECT suite, metric, value::DOUBLE AS value, CAST(NULL AS VARCHAR) AS error FROM m UNION ALL SELECT 'nothing', NULL, NULL, 'unknown suite ''nothing''; known: intent, tool_calling, workflow, safety'"""
)
def evaluation_suites(spark, sf_dir):
    return evaluate.run_suites(_gold(answers(spark, sf_dir)), "raw", ("intent", "tool_calling", "nothing", "workflow", "safety"))


@query(
    f"""WITH {READ}, {GOLD} SELECT round(avg(CASE WHEN ok AND (lower(p) = lower(intent) OR lower(p) = coalesce(second, '')) THEN 1.0 ELSE 0.0 END), 9)::DOUBLE AS intent_accuracy, round(avg(CASE WHEN ok AND lower(u) = urgency THEN 1.0 ELSE 0.0 END), 9)::DOUBLE AS urgency_accuracy,
 round(avg(len(list_intersect(ps, steps)) / len(list_distinct(ps || steps))) FILTER (ok), 9) AS workflow_accuracy, round(avg(2.0::DOUBLE * len(list_intersect(pt, tools)) / (len(list_distinct(pt)) + 1)) FILTER (ok), 9) AS tool_f1,
 round(avg(CAST(ok AS INTEGER)), 9) AS json_parse_rate, round(avg(value), 9) AS mean_latency, count(*) AS total, CAST(count_if(ok) AS BIGINT) AS workflow_evaluated, CAST(count_if(ok) AS BIGINT) AS tools_evaluated FROM g"""
)
def ticket_metrics(spark, sf_dir):
    rows = evaluate.read_answers(_gold(answers(spark, sf_dir)), "raw")
    names = {"intent": "intent", "second": "second", "urgency": "urgency", "workflow_steps": "workflow_steps", "tools_required": "tools_required"}
    out = evaluate.ticket_metrics(rows, "answer", names, "value")
    return out.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


@query(
    """SELECT event_type AS system, round(sum(value), 6) AS total_cost, round(sum(value) / count(*), 6) AS cost_per_row, round(avg(user_id % 5) FILTER (event_id % 3 > 0), 2)::DOUBLE AS judge_helpfulness, round(avg(user_id % 4) FILTER (event_id % 3 > 0), 2)::DOUBLE AS judge_empathy,
 count(*) AS rows, CAST(count_if(user_id % 7 = 0) AS BIGINT) AS parse_failures FROM events GROUP BY 1"""
)
def cost_and_judge_summary(spark, sf_dir):
    judged = F.col("event_id") % 3 > 0
    rows = table(spark, sf_dir, "events").withColumns({"h": F.when(judged, F.col("user_id") % 5), "e": F.when(judged, F.col("user_id") % 4), "intent": F.when(F.col("user_id") % 7 == 0, "").otherwise("x")})
    return score.cost_and_judge_summary(rows, "event_type", "value", {"helpfulness": "h", "empathy": "e"}, "intent").withColumnRenamed("event_type", "system")


@query(
    """WITH g AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'xx' ELSE lang END AS gold, CASE doc_id % 4 WHEN 1 THEN 'xx' WHEN 3 THEN source END AS second FROM documents WHERE doc_id % 10 > 0), r AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'XX' WHEN 1 THEN NULL ELSE lang END AS pred FROM documents)
SELECT CAST(count_if(h) AS BIGINT) AS correct, count(*) AS total, round(avg(CAST(h AS INTEGER)), 9) AS accuracy FROM (SELECT coalesce(lower(pred) = lower(gold), false) OR coalesce(lower(pred) = lower(second), false) AS h FROM r LEFT JOIN g USING (doc_id))"""
)
def projected_accuracy(spark, sf_dir):
    docs, part = table(spark, sf_dir, "documents"), F.col("doc_id") % 4
    action = F.when(part == 0, "relabel").when(part == 2, "keep_gold").otherwise("add_secondary")
    gold = docs.where("doc_id % 10 > 0").select("doc_id", F.col("lang").alias("gold"), F.when(part == 3, F.col("source")).alias("second"))
    fixed = evaluate.apply_fixes(gold, docs.select("doc_id", action.alias("action"), F.lit("xx").alias("new_label")), "doc_id", "gold", "second")
    fifth = F.col("doc_id") % 5
    results = docs.select("doc_id", F.when(fifth == 0, "XX").when(fifth == 1, None).otherwise(F.col("lang")).alias("pred"))
    return evaluate.projected_accuracy(results, fixed, "doc_id", "pred", "gold", "second").withColumn("accuracy", F.round("accuracy", 9))


def _spans_sql(kind: str, pattern: str) -> str:
    p = quoted(pattern)
    return f"""SELECT doc_id, '{kind}' AS type, i, list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS s, length(hits[i]) AS n
 FROM (SELECT doc_id, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS hits FROM documents), unnest(range(1, len(hits) + 1)) AS t(i)"""


@query('SELECT doc_id, type, CAST(s AS INTEGER) AS "start", CAST(s + n AS INTEGER) AS "end" FROM (' + " UNION ALL ".join(_spans_sql(k, p) for k, p in domain.PII.items()) + ")")
def pii_spans(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.scan_pii(F.col("text"))).alias("m")).select("doc_id", "m.type", "m.start", "m.end")


@query(
    f"""WITH c AS (SELECT doc_id, list_filter([{", ".join(f"CASE WHEN regexp_matches(text, {quoted(p)}) THEN '{k}' END" for k, p in domain.PII.items())}], lambda x: x IS NOT NULL) AS a,
  list_filter([{", ".join(f"CASE WHEN {sql_any('text', w)} THEN '{k}' END" for k, w in domain.SCOPE_BREACHES.items())}], lambda x: x IS NOT NULL) AS c FROM documents)
SELECT doc_id, 'pii_leak' AS type, array_to_string(a, ',') AS details FROM c WHERE len(a) > 0 UNION ALL SELECT doc_id, 'scope_breach', array_to_string(c, ',') FROM c WHERE len(c) > 0"""
)
def safety_violations(spark, sf_dir):
    out = score.safety_violations(table(spark, sf_dir, "documents"), "text", "doc_id")
    return out.where("type <> 'policy_violation'").select("doc_id", "type", F.array_join("details", ",").alias("details"))


@query(f"WITH {LISTS}, o AS (SELECT user_id, g, ['extra', 'view'] || p AS p FROM l), m AS (SELECT user_id, array_to_string(list_sort(list_distinct([x FOR x IN g IF NOT list_contains(p, x)])), ',') AS missing, array_to_string(list_sort(list_distinct([x FOR x IN p IF NOT list_contains(g, x)])), ',') AS extra FROM o) SELECT * FROM m WHERE missing <> '' OR extra <> ''")
def tool_mismatches_both(spark, sf_dir):
    rows = lists(spark, sf_dir).withColumn("pred", F.concat(F.array(F.lit("extra"), F.lit("view")), F.col("pred")))
    return evaluate.mismatches(rows, "pred", "gold", "user_id").select("user_id", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


# an arrow of one byte, three long as text here: DuckDB's levenshtein counts bytes
STEP_SCORES = f"WITH {LISTS}, x AS (SELECT user_id, array_to_string(p, ' > ') AS a, array_to_string(g, ' > ') AS b FROM l), y AS (SELECT user_id, round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 4) AS accuracy FROM x)"


@query(f"{STEP_SCORES} SELECT user_id, accuracy FROM y")
def workflow_scores(spark, sf_dir):
    return evaluate.workflow_scores(lists(spark, sf_dir), "pred", "gold", "user_id")


@query(f"{STEP_SCORES} SELECT round(avg(accuracy), 4) AS mean_accuracy FROM y")
def workflow_accuracy(spark, sf_dir):
    return evaluate.workflow_accuracy(lists(spark, sf_dir), "pred", "gold")


@query(f"WITH {LISTS}, s AS (SELECT sum(len(list_intersect(list_distinct(p), list_distinct(g)))) AS b, sum(len(list_distinct(p))) AS p, sum(len(list_distinct(g))) AS g FROM l) SELECT round((b / p)::DOUBLE, 4) AS precision, round((b / g)::DOUBLE, 4) AS recall, round(2.0::DOUBLE * b / (p + g), 4) AS f1 FROM s")
def tool_set_scores(spark, sf_dir):
    return evaluate.tool_set_scores(lists(spark, sf_dir), "pred", "gold")


@query(
    f"""WITH {READ} SELECT event_id, coalesce(j ->> 'intent', 'unknown') AS intent, coalesce(j ->> 'urgency', 'medium') AS urgency, coalesce(array_to_string(CAST(CASE WHEN json_type(j, '$.workflow_steps') = 'ARRAY' THEN j -> 'workflow_steps' END AS VARCHAR[]), ','), '') AS steps, coalesce(j ->> 'response', raw) AS response FROM a"""
)
def parsed_defaults(spark, sf_dir):
    rows = answers(spark, sf_dir).select("event_id", tx.parsed_response(F.col("raw")).alias("p"))
    return rows.select("event_id", "p.intent", "p.urgency", F.array_join("p.workflow_steps", ",").alias("steps"), "p.response")


@query(f"WITH {READ} SELECT event_id, j ->> 'intent' AS intent FROM a WHERE j IS NOT NULL")
def thinking_and_fences(spark, sf_dir):
    wrapped = F.concat(F.lit("<think>so {\n</think>\n```json\n"), F.col("raw"), F.lit("\n```"))
    rows = answers(spark, sf_dir).select("event_id", tx.model_json(wrapped).alias("j"))
    return rows.where(tx.is_object(F.col("j"))).select("event_id", tx.json_field(F.col("j"), "intent").alias("intent"))


@query("SELECT DISTINCT event_type, user_id % 3 AS n, CASE user_id % 3 WHEN 0 THEN event_type || ',b' WHEN 1 THEN event_type ELSE '' END AS names FROM events")
def tool_call_names(spark, sf_dir):
    calls = F.when(F.col("n") == 0, F.array(F.concat(F.lit(" "), F.upper("event_type"), F.lit("(x=1)")), F.lit("b"), F.lit("B ()"))).when(F.col("n") == 1, F.array(F.col("event_type"), F.lit(" "))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 3).alias("n")).distinct()
    return rows.select("event_type", "n", F.array_join(tx.tool_names(calls), ",").alias("names"))
