"""Rewards, safety and personal data over the driver's documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators import score
from corpusmill.plans.common import STRIP, quoted, sql_any, sql_count, table
from corpusmill.plans.registry import query

HITS = {k: f"regexp_matches(text, {quoted(p)})" for k, p in domain.PII.items()}
AMOUNTS = r"len(list_filter(regexp_extract_all(text, '\$\s*([\d,]+(?:\.\d{2})?)', 1), lambda a: try_cast(replace(a, ',', '') AS DOUBLE) > 500))"
N_PII = "(" + " + ".join(f"CAST({h} AS INTEGER)" for h in HITS.values()) + ")"
ADVICE = "(" + " + ".join(f"CAST({sql_any('text', w)} AND {sql_any('text', domain.ADVISING)} AS INTEGER)" for w in domain.ADVICE_WORDS.values()) + ")"
CLAIM = "(" + " OR ".join(f"regexp_matches(lower(text), {quoted(p)})" for p in domain.CLAIMS) + ")"
POLICY = f"""round(greatest(-1.0, least(0.5, 0.5 - 0.5 * {N_PII} - 0.3 * {AMOUNTS} - CASE WHEN {sql_any('text', domain.FRAUD_WORDS)} AND NOT {sql_any('text', domain.ESCALATION_WORDS)} THEN 0.5 ELSE 0.0 END
 - 0.3 * {ADVICE} - CASE WHEN {CLAIM} AND NOT {sql_any('text', ('tool', 'api'))} THEN 0.2 ELSE 0.0 END)), 6)::DOUBLE"""
CAPS = r"len(list_filter(regexp_extract_all(s, '[\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '[A-Z]{4,}') AND w NOT IN (" + ", ".join(map(quoted, domain.ALLOWED_CAPS)) + ")))"
INFORMAL = r"len(list_filter(regexp_extract_all(lower(s), '[\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, " + quoted(domain.INFORMAL.replace(r"\b", "")) + ")))"
HAS = lambda words, v: f"CASE WHEN {sql_any('s', words)} THEN {v} ELSE 0.0 END"
QUALITY = f"""round(CASE WHEN s = '' THEN 0.0 ELSE CASE WHEN {sql_count('s', domain.ACTION_WORDS)} >= 3 THEN 0.25 WHEN {sql_count('s', domain.ACTION_WORDS)} >= 1 THEN 0.15 ELSE 0.05 END
 + CASE WHEN length(s) < 20 THEN 0.0 WHEN length(s) < 50 THEN 0.10 WHEN length(s) > 2000 THEN 0.05 WHEN length(s) > 1000 THEN 0.15 ELSE 0.25 END
 + greatest(0.0, 0.25 - CASE WHEN {INFORMAL} > 0 THEN 0.15 ELSE 0.0 END - CASE WHEN regexp_matches(s, '[!?]{{3,}}') THEN 0.10 ELSE 0.0 END - CASE WHEN {CAPS} > 2 THEN 0.10 ELSE 0.0 END)
 + {HAS(domain.ADDRESS_WORDS, 0.10)} + {HAS(domain.EMPATHY_WORDS, 0.10)} + {HAS(domain.CONTEXT_WORDS, 0.05)} END, 6)::DOUBLE"""


@query(f"SELECT doc_id, {POLICY} AS policy FROM documents")
def policy_reward(spark, sf_dir):
    return score.rewards(table(spark, sf_dir, "documents"), "text", ("policy",)).select("doc_id", F.round("policy", 6).alias("policy"))


@query(f"SELECT doc_id, {QUALITY} AS quality FROM (SELECT doc_id, {STRIP} AS s FROM documents)")
def quality_reward(spark, sf_dir):
    return score.rewards(table(spark, sf_dir, "documents"), "text", ("quality",)).select("doc_id", F.round("quality", 6).alias("quality"))


ANSWER = "'{\"intent\": \"' || event_type || '\", \"urgency\": \"low\", \"workflow_steps\": [\"a\"], \"tools_required\": [' || CASE WHEN value > 50 THEN '\"vision_api\", \"nothing\"' ELSE '' END || '], \"reasoning\": \"r\", \"response\": \"You will have it.\"' || CASE event_id % 3 WHEN 0 THEN '}' WHEN 1 THEN ', \"more\": 1}' ELSE '' END"


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 0.0 ELSE 1.0 END::DOUBLE AS format, CASE WHEN event_id % 3 = 2 THEN 0.0 WHEN value > 50 THEN 0.25 ELSE 0.8 END::DOUBLE AS tool_accuracy FROM events")
def structured_rewards(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("answer", F.expr(ANSWER))
    return score.rewards(rows, "answer", ("format", "tool_accuracy")).select("event_id", "format", "tool_accuracy")


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 0.3 WHEN value > 50 THEN 0.9 ELSE 0.8 END::DOUBLE AS confidence, CASE WHEN event_id % 3 = 2 THEN 'unknown' ELSE event_type END AS intent, event_id % 3 = 2 AS escalate FROM events")
def postprocess_answers(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("answer", F.expr(ANSWER))
    return score.postprocess(rows, "answer").select("event_id", "confidence", "intent", "escalate")


SCOPE = " OR ".join(sql_any("text", w) for w in domain.SCOPE_BREACHES.values())
UNESCALATED = "(regexp_matches(text, '(?i)fraud|unauthorized|stolen') AND NOT regexp_matches(regexp_extract(text, '(?is)^.*(?:fraud|unauthorized|stolen)(.*)$', 1), '(?i)escalat|supervisor|security'))"


@query(
    f"""WITH c AS (SELECT CAST({N_PII} > 0 AS INTEGER) AS a, CAST(regexp_matches(text, {quoted(domain.UNAUTHORIZED_REFUND)}) OR {UNESCALATED} AS INTEGER) AS b, CAST({SCOPE} AS INTEGER) AS c FROM documents)
SELECT avg(a) AS pii_leak_rate, avg(b) AS policy_violation_rate, avg(c) AS scope_breach_rate, CAST(sum(a + b + c) AS BIGINT) AS total_violations, count(*) AS num_examples FROM c"""
)
def safety_suite(spark, sf_dir):
    return score.safety_summary(table(spark, sf_dir, "documents"), "text")


@query("SELECT doc_id, type FROM (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS type FROM documents WHERE {h}" for k, h in HITS.items()) + ")")
def pii_types(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.pii_types(F.col("text"))).alias("type"))


@query("SELECT type, CAST(sum(n) AS BIGINT) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS type, len(regexp_extract_all(text, {quoted(p)})) AS n FROM documents" for k, p in domain.PII.items()) + ") GROUP BY type")
def pii_audit(spark, sf_dir):
    return score.pii_audit(table(spark, sf_dir, "documents"), "text")


def _replaced_sql(text: str) -> str:
    for _, pattern, tag in score.REPLACEMENTS:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(tag)}, 'g')"
    return text


@query(f"SELECT doc_id, {_replaced_sql('text')} AS text FROM documents")
def anonymize(spark, sf_dir):
    return score.anonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])
