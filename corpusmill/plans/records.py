"""Conversion of records, enrichment, tool calls, costs and label repair over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators import convert, evaluate, score
from corpusmill.plans.cleaning import CHATS, _urgency_sql
from corpusmill.plans.common import quoted, sql_lookup, table
from corpusmill.plans.registry import query
from corpusmill.plans.scoring import ANSWER


def _sql_list(words) -> str:
    return "[" + ", ".join(map(quoted, words)) + "]"


def _sql_lists(mapping, key: str, default) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {quoted(k)} THEN {_sql_list(v)}" for k, v in mapping.items()) + f" ELSE {_sql_list(default)} END"


BANKING = {x: intent for intent, labels in domain.BANKING_LABELS.items() for x in labels}
BANKING_NAMES = sorted(BANKING)
SCOPE = {x: intent for intent, labels in domain.SCOPE_LABELS.items() for x in labels}
SCOPE_NAMES = [*SCOPE, "oos", "greeting"]


def _answered(rows):
    parsed = tx.strict_json(F.col("messages")[2]["content"])
    listed = lambda n: tx.json_field(parsed, n, "array<string>")
    return rows.select(
        "doc_id", F.col("messages")[1]["content"].alias("user_message"), tx.json_field(parsed, "intent").alias("intent"), tx.json_field(parsed, "urgency").alias("urgency"),
        F.array_join(listed("workflow_steps"), ",").alias("steps"), F.array_join(listed("tools_required"), ",").alias("tools"),
    )


def _answered_sql(names, intents, urgencies, steps, tools) -> str:
    label = f"{_sql_list(names)}[doc_id % {len(names)} + 1]"
    return f"""WITH l AS (SELECT doc_id, text, {label} AS label FROM documents),
 x AS (SELECT doc_id, text, {sql_lookup(intents, 'label', 'general_inquiry')} AS intent, {_urgency_sql('(' + sql_lookup(urgencies, 'label', 'medium') + ')')} AS urgency FROM l)
SELECT doc_id, text AS user_message, intent, urgency, array_to_string({_sql_lists(domain.CATEGORY_STEPS, 'intent', steps)}, ',') AS steps, array_to_string({_sql_lists(domain.CATEGORY_TOOLS, 'intent', tools)}, ',') AS tools FROM x"""


@query(_answered_sql(BANKING_NAMES, BANKING, domain.BANKING_URGENCY, ("verify_identity", "resolve_issue"), ("customer_profile_api",)))
def convert_banking_messages(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("label", F.col("doc_id") % len(BANKING_NAMES))
    return _answered(convert.from_banking(rows))


@query(_answered_sql(SCOPE_NAMES, SCOPE, domain.SCOPE_URGENCY, ("assess_request", "provide_information"), ("ticket_update_api",)))
def convert_scope_messages(spark, sf_dir):
    name = F.get(F.array(*map(F.lit, SCOPE_NAMES)), (F.col("doc_id") % len(SCOPE_NAMES)).cast("int"))
    return _answered(convert.from_scope_labels(table(spark, sf_dir, "documents").withColumn("intent", name)))


def _shown(messages):
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|")


ROLED = "array_to_string([x.role || '=' || x.content FOR x IN m], '|')"
SYSTEM = quoted("system=" + domain.SYSTEM_PROMPT)


@query(f"WITH c AS ({CHATS}) SELECT conv_id, CASE WHEN len([x FOR x IN m IF x.role = 'system']) = 0 THEN {SYSTEM} || '|' ELSE '' END || {ROLED} AS shown FROM c")
def convert_turn_lists(spark, sf_dir):
    chats = convert.threads(table(spark, sf_dir, "conversations"))
    other = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    turns = F.transform("messages", lambda m: F.struct(other(m["role"]).alias("from"), m["content"].alias("value")))
    return convert.from_turns(chats.select("conv_id", turns.alias("conversations"))).select("conv_id", _shown(F.col("messages")).alias("shown"))


STRIPPED = r"regexp_replace(regexp_replace(x.content, '^\s+', ''), '\s+$', '')"


@query(
    f"""WITH c AS ({CHATS}), s AS (SELECT conv_id, [x.role || '=' || {STRIPPED} FOR x IN m IF {STRIPPED} <> ''] AS l, array_to_string([upper(x.role) || ': ' || x.content FOR x IN m], chr(10)) AS chat FROM c)
SELECT conv_id, CASE WHEN len(l) >= 2 THEN array_to_string(l, '|') ELSE {SYSTEM} || '|user=' || chat || '|assistant=' END AS shown FROM s"""
)
def convert_marked_text(spark, sf_dir):
    chats = convert.threads(table(spark, sf_dir, "conversations"))
    chat = F.array_join(F.transform("messages", lambda m: F.concat(F.upper(m["role"]), F.lit(": "), m["content"])), "\n")
    return convert.from_marked_text(chats.select("conv_id", chat.alias("chat"))).select("conv_id", _shown(F.col("messages")).alias("shown"))


@query("SELECT event_id, event_type AS asked, CASE WHEN event_id % 3 = 0 THEN 'No tool call needed.' ELSE '[\"' || event_type || '\"]' END AS answer FROM events")
def convert_function_calls(spark, sf_dir):
    answers = F.concat(F.lit('["'), F.col("event_type"), F.when(F.col("event_id") % 3 == 0, '"').otherwise('"]'))
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("query"), F.lit("[]").alias("tools"), answers.alias("answers"))
    return convert.from_function_calls(rows).select("event_id", F.col("messages")[1]["content"].alias("asked"), F.col("messages")[2]["content"].alias("answer"))


@query(
    """SELECT event_id, '{"intent":"' || event_type || '","urgency":"low","workflow_steps":["check","' || event_type || '"],"tools_required":["policy_engine"],"reasoning":"Customer intent is ' || event_type
 || ' with low urgency. Required workflow: check → ' || event_type || '.","response":"done"}' AS answer FROM events"""
)
def convert_annotated(spark, sf_dir):
    steps, tools = F.array(F.lit("check"), F.col("event_type")), F.array(F.lit("policy_engine"))
    rows = table(spark, sf_dir, "events").select("event_id", F.lit("hello").alias("customer_message"), F.col("event_type").alias("intent"), F.lit("low").alias("urgency"), steps.alias("workflow_steps"), tools.alias("tools_required"), F.lit("done").alias("agent_response"))
    return convert.from_annotated(rows).select("event_id", F.col("messages")[2]["content"].alias("answer"))


def _answers(spark, sf_dir):
    """Events with a chat of their structured answer; one in three is broken JSON."""
    rows = table(spark, sf_dir, "events").withColumn("answer", F.expr(ANSWER))
    return rows.withColumn("messages", F.array(convert.message("user", F.col("event_type")), convert.message("assistant", F.col("answer"))))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'broken' WHEN value > 50 THEN 'high:vision_api:1,2,3,4,5,6' ELSE 'medium::1,2,3,4,5,6' END AS enriched FROM events"""
)
def enrich_answers(spark, sf_dir):
    rows = _answers(spark, sf_dir)
    steps, many = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: i.cast("string")), F.col("value") > 50
    tools = F.when(many, F.array(F.lit("vision_api"), F.lit("nothing"))).otherwise(F.array(F.lit("nothing")))
    done = convert.apply_enrichment(F.col("messages"), steps, tools, F.when(many, "high").otherwise("at once"))
    parsed = tx.strict_json(done[1]["content"])
    listed = lambda n: F.array_join(tx.json_field(parsed, n, "array<string>"), ",")
    return rows.select("event_id", F.coalesce(F.concat(tx.json_field(parsed, "urgency"), F.lit(":"), listed("tools_required"), F.lit(":"), listed("workflow_steps")), F.lit("broken")).alias("enriched"))


@query("SELECT event_id, event_type AS customer_message, CASE WHEN event_id % 3 = 2 THEN 'general_inquiry' ELSE event_type END AS intent FROM events")
def customer_and_intent(spark, sf_dir):
    return _answers(spark, sf_dir).select("event_id", convert.last_user(F.col("messages")).alias("customer_message"), convert.stated_intent(F.col("messages")).alias("intent"))


@query("SELECT round(avg(CASE WHEN event_id % 3 = 2 THEN 0.0 ELSE 1.0 END), 9)::DOUBLE AS json_rate, round(avg(CASE WHEN event_id % 3 = 2 THEN 0.0 ELSE 1.0 END), 9)::DOUBLE AS schema_rate FROM events")
def schema_validity(spark, sf_dir):
    out = evaluate.schema_validity(_answers(spark, sf_dir), "answer")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


TOOL = "CASE event_id % 3 WHEN 0 THEN 'refund_processing_api' WHEN 1 THEN 'vision_api' ELSE 'unheard_of' END"
GIVEN = "CASE WHEN value > 50 THEN ['order_id', 'image_url'] ELSE ['order_id', 'amount'] END"


@query(
    f"""WITH c AS (SELECT event_id, {TOOL} AS tool, value > 50 AS big FROM events)
SELECT event_id, tool, CASE WHEN tool = 'unheard_of' THEN 'unknown_tool' WHEN (tool = 'vision_api') = big THEN 'success' ELSE 'missing_parameters' END AS status,
 CASE WHEN tool = 'unheard_of' OR (tool = 'vision_api') = big THEN '' WHEN big THEN 'amount' ELSE 'image_url' END AS missing FROM c"""
)
def tool_call_checks(spark, sf_dir):
    given = F.when(F.col("value") > 50, F.array(F.lit("order_id"), F.lit("image_url"))).otherwise(F.array(F.lit("order_id"), F.lit("amount")))
    rows = table(spark, sf_dir, "events").select("event_id", score.execute_call(F.expr(TOOL), given).alias("c"))
    return rows.select("event_id", "c.tool", "c.status", F.array_join("c.missing", ",").alias("missing"))


@query(f"WITH c AS ({CHATS}) SELECT conv_id, len([i FOR i IN range(1, len(m) + 1) IF m[i].role = 'user' AND (i = len(m) OR m[i + 1].role <> 'assistant')]) = 0 AS answered FROM c")
def tool_calls_answered(spark, sf_dir):
    chats = convert.threads(table(spark, sf_dir, "conversations"))
    as_calls = lambda m: F.when(m["role"] == "user", convert.message("assistant", F.lit('{"name": "policy_engine"}'))).when(m["role"] == "assistant", convert.message("tool", m["content"])).otherwise(convert.message("user", m["content"]))
    return chats.select("conv_id", convert.tool_calls_answered(F.transform("messages", as_calls)).alias("answered"))


@query("SELECT event_type AS model, round(sum((value * CASE event_type WHEN 'view' THEN 0.5 ELSE 1.0 END + 10 * CASE event_type WHEN 'view' THEN 1.5 ELSE 3.0 END)::DOUBLE / 1e6), 9) AS cost FROM events GROUP BY 1")
def call_costs(spark, sf_dir):
    price = score.cost(F.col("value"), F.lit(10), F.col("event_type"), {"view": (0.5, 1.5)})
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model")).agg(F.round(F.sum(price), 9).alias("cost"))


TARGETS = {"view": 40.0, "click": 60.0}


@query("SELECT event_type AS metric, round(avg(value), 9) AS value, CASE event_type WHEN 'view' THEN 40.0::DOUBLE ELSE 60.0 END AS target, avg(value) >= CASE event_type WHEN 'view' THEN 40.0 ELSE 60.0 END AS met FROM events WHERE event_type IN ('view', 'click') GROUP BY 1")
def metrics_against_targets(spark, sf_dir):
    means = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    return evaluate.against_targets(means, TARGETS).withColumn("value", F.round("value", 9))


@query(
    """WITH g AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'fr' ELSE lang END AS gold, CASE WHEN doc_id % 4 = 1 THEN 'de' END AS second, lang AS pred FROM documents)
SELECT round(avg(CAST(pred = gold OR coalesce(second, '') = pred AS INTEGER)), 9) AS accuracy, 1.0::DOUBLE AS parsed, count(*) AS n FROM g"""
)
def answer_metrics(spark, sf_dir):
    third = F.col("doc_id") % 4
    rows = table(spark, sf_dir, "documents").withColumns({"gold": F.upper(F.when(third == 0, "fr").otherwise(F.col("lang"))), "second": F.when(third == 1, "de")})
    return evaluate.answer_metrics(rows, "lang", "gold", "second").withColumn("accuracy", F.round("accuracy", 9))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'xx' ELSE lang END AS lang, CASE doc_id % 4 WHEN 1 THEN 'xx' WHEN 3 THEN source END AS secondary FROM documents")
def repaired_labels(spark, sf_dir):
    docs, third = table(spark, sf_dir, "documents"), F.col("doc_id") % 4
    gold = docs.select("doc_id", "lang", F.when(third == 3, F.col("source")).alias("secondary"))
    action = F.when(third == 0, "relabel").when(third == 2, "keep_gold").otherwise("add_secondary")
    return evaluate.apply_fixes(gold, docs.select("doc_id", action.alias("action"), F.lit("xx").alias("new_label")), "doc_id", "lang", "secondary")


@query("SELECT user_id, event_id, event_type AS rejected, 'view' AS chosen FROM events WHERE event_type <> 'view'")
def correction_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", evaluate.correction_pair(F.col("event_type"), F.lit("view")).alias("p"))
    return rows.where("p IS NOT NULL").select("user_id", "event_id", "p.rejected", "p.chosen")


@query(
    f"""WITH c AS ({CHATS}), p AS (SELECT conv_id, [x.content FOR x IN m IF x.role <> 'assistant'] AS prompt, [x.content FOR x IN m IF x.role = 'assistant'] AS said FROM c)
SELECT conv_id, array_to_string(prompt, '|') AS prompt, array_to_string(said, '|') AS chosen, array_to_string([x || '!' FOR x IN said], '|') AS rejected FROM p WHERE len(said) > 0 AND said <> [x || '!' FOR x IN said]"""
)
def preferred_turns(spark, sf_dir):
    chats = convert.threads(table(spark, sf_dir, "conversations"))
    louder = F.transform("messages", lambda m: convert.message(m["role"], F.concat(m["content"], F.lit("!"))))
    rows = chats.select("conv_id", convert.preferred_turns(F.col("messages"), louder).alias("p")).where("p IS NOT NULL")
    said = lambda n: F.array_join(F.transform(f"p.{n}", lambda m: m["content"]), "|").alias(n)
    return rows.select("conv_id", said("prompt"), said("chosen"), said("rejected"))


@query(
    """WITH s AS (SELECT event_type AS v, count(*) AS n, avg(value) AS m, var_samp(value) AS q FROM events GROUP BY 1), a AS (SELECT * FROM s WHERE v = 'view'), b AS (SELECT n AS n2, m AS m2, q AS q2 FROM s WHERE v = 'click')
SELECT round((m - m2) / sqrt(((n - 1) * q + (n2 - 1) * q2) / (n + n2 - 2) * (1.0 / n + 1.0 / n2)), 6) AS t FROM a, b"""
)
def variant_t_test(spark, sf_dir):
    return evaluate.significance(table(spark, sf_dir, "events"), "event_type", "value", "view", "click").select(F.round("t", 6).alias("t"))
