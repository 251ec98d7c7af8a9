"""The preparation chain, pairs, contracts, tickets and experiments over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators import convert, evaluate, mix, profile, quality, score
from corpusmill.plans.cleaning import CHATS, _urgency_sql
from corpusmill.plans.common import NON_ASCII, STRIP, WORDS, quoted, sql_any, sql_lookup, table
from corpusmill.plans.records import ROLED, SYSTEM, _shown, _sql_list, _sql_lists
from corpusmill.plans.registry import query
from corpusmill.sources import readers

def _label_answer(names, intents, urgencies, steps, tools, response, where="TRUE", oos=False) -> str:
    """SQL of the whole answer of a labelled text, with label numbers doc_id % the number of names."""
    label = f"{_sql_list(names)}[doc_id % {len(names)} + 1]"
    plain = "replace(label, '_', ' ')"
    reasoning = f"{quoted(domain.LABEL_REASONING[0])} || {plain} || {quoted(domain.LABEL_REASONING[1])} || intent || {quoted(domain.LABEL_REASONING[2])} || urgency || {quoted(domain.LABEL_REASONING[3])}"
    said = f"{quoted(response[0])} || {plain} || {quoted(response[1])}"
    if oos:
        reasoning, said = (f"CASE WHEN label = 'oos' THEN {quoted(o)} ELSE {x} END" for o, x in ((domain.OUT_OF_SCOPE_REASONING, reasoning), (domain.OUT_OF_SCOPE_RESPONSE, said)))
    fields = f"{{'intent': intent, 'urgency': urgency, 'workflow_steps': {_sql_lists(domain.CATEGORY_STEPS, 'intent', steps)}, 'tools_required': {_sql_lists(domain.CATEGORY_TOOLS, 'intent', tools)}, 'reasoning': {reasoning}, 'response': {said}}}"
    return f"""l AS (SELECT doc_id, text, lang, {label} AS label FROM documents), x AS (SELECT *, {sql_lookup(intents, 'label', 'general_inquiry')} AS intent, {_urgency_sql('(' + sql_lookup(urgencies, 'label', 'medium') + ')')} AS urgency FROM l WHERE {where}),
 done AS (SELECT doc_id, text, CAST(to_json({fields}) AS VARCHAR) AS answer FROM x)"""


BANKING = _label_answer(sorted(domain.BANKING_INTENT), domain.BANKING_INTENT, domain.BANKING_URGENCY, ("verify_identity", "resolve_issue"), ("customer_profile_api",), domain.BANKING_RESPONSE)
SCOPE = (domain.SCOPE_NAMES, domain.SCOPE_INTENT, domain.SCOPE_URGENCY, ("assess_request", "provide_information"), ("ticket_update_api",), domain.SCOPE_RESPONSE)


@query(f"WITH {BANKING} SELECT doc_id, answer FROM done")
def banking_answers_by_number(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("label", F.col("doc_id") % len(domain.BANKING_INTENT))
    return convert.convert_rows(rows, "banking77", ["doc_id"]).select("doc_id", F.col("messages")[2]["content"].alias("answer"))


@query(f"WITH {_label_answer(*SCOPE, oos=True)} SELECT doc_id, answer FROM done")
def scope_answers_by_number(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("intent", F.col("doc_id") % len(domain.SCOPE_NAMES))
    return convert.convert_rows(rows, "clinc", ["doc_id"]).select("doc_id", F.col("messages")[2]["content"].alias("answer"))


@query(f"WITH {_label_answer(*SCOPE, where=f'lang = ' + quoted('en') + ' AND list_contains(' + _sql_list(domain.SERVICE_LABELS) + ', label)', oos=True)} SELECT doc_id, text AS user_message, answer, 'clinc_oos' AS source FROM done ORDER BY md5(doc_id || ':42'), doc_id LIMIT 60")
def convert_and_keep(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumns({"intent": F.col("doc_id") % len(domain.SCOPE_NAMES), "language": F.col("lang")})
    kept = convert.convert_and_keep(rows, "clinc", "clinc_oos", key="doc_id", language="en", service_only=True, most=60)
    return kept.select("doc_id", F.col("messages")[1]["content"].alias("user_message"), F.col("messages")[2]["content"].alias("answer"), "source")


def _category(names, by):
    return F.get(F.array(*map(F.lit, names)), (F.col(by) % len(names)).cast("int"))


def _ticket_sql(names, intents, urgency, steps, tools, reasoning, column) -> str:
    fields = f"{{'intent': intent, 'urgency': urgency, 'workflow_steps': {_sql_lists(steps, 'intent', ('assess_request', 'resolve_issue'))}, 'tools_required': {_sql_lists(tools, 'intent', ('ticket_update_api',))}, 'reasoning': {reasoning}, 'response': source}}"
    return f"""WITH l AS (SELECT *, {_sql_list(names)}[doc_id % {len(names)} + 1] AS {column}, [{', '.join(map(quoted, ('high', 'odd', 'low')))}][doc_id % 3 + 1] AS priority FROM documents),
 i AS (SELECT *, {sql_lookup(intents, column, 'general_inquiry')} AS intent, {urgency} AS base FROM l), u AS (SELECT *, {_urgency_sql('base')} AS urgency FROM i) SELECT doc_id, CAST(to_json({fields}) AS VARCHAR) AS answer FROM u"""


CATEGORIES, QUEUES = [*domain.CATEGORY_INTENT, "NONE"], [*domain.QUEUE_INTENT, "Elsewhere"]
CATEGORY_SAID = f"{quoted(domain.CATEGORY_REASONING[0])} || intent || {quoted(domain.CATEGORY_REASONING[1])} || lang || {quoted(domain.CATEGORY_REASONING[2])} || urgency || {quoted(domain.CATEGORY_REASONING[3])}"
QUEUE_SAID = f"{quoted(domain.QUEUE_REASONING[0])} || queue || {quoted(domain.QUEUE_REASONING[1])} || priority || {quoted(domain.QUEUE_REASONING[2])} || lang || {quoted(domain.QUEUE_REASONING[3])} || intent || {quoted(domain.QUEUE_REASONING[4])}"


@query(_ticket_sql(CATEGORIES, domain.CATEGORY_INTENT, "(" + sql_lookup(domain.CATEGORY_URGENCY, "category", "medium") + ")", domain.CATEGORY_STEPS, domain.CATEGORY_TOOLS, CATEGORY_SAID, "category"))
def category_answers(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("instruction"), F.lower(_category(CATEGORIES, "doc_id")).alias("category"), F.col("lang").alias("intent"), F.col("source").alias("response"))
    return convert.convert_rows(rows, "bitext", ["doc_id"]).select("doc_id", F.col("messages")[2]["content"].alias("answer"))


@query(_ticket_sql(QUEUES, domain.QUEUE_INTENT, "(CASE WHEN priority = 'odd' THEN 'medium' ELSE priority END)", domain.QUEUE_STEPS, domain.QUEUE_TOOLS, QUEUE_SAID, "queue"))
def queue_answers(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"), _category(QUEUES, "doc_id").alias("queue"), _category(("high", "odd", "low"), "doc_id").alias("priority"), F.col("lang").alias("type"), F.col("source").alias("answer"))
    return convert.convert_rows(rows, "ticket", ["doc_id"]).select("doc_id", F.col("messages")[2]["content"].alias("answer"))


NO_TURNS = "CASE WHEN conv_id % 7 = 0 THEN NULL WHEN conv_id % 7 = 1 THEN [] ELSE m END"


def _chats(spark, sf_dir):
    return convert.threads(table(spark, sf_dir, "conversations"))


def _sometimes(df, turns):
    """The turns, null for one chat in seven and an empty list for another."""
    seventh = F.col("conv_id") % 7
    return df.withColumn("conversations", F.when(seventh == 0, None).when(seventh == 1, F.slice(turns, 1, 0)).otherwise(turns))


@query(f"WITH c AS ({CHATS}), n AS (SELECT conv_id, {NO_TURNS} AS m FROM c) SELECT conv_id, CASE WHEN m IS NULL OR len(m) = 0 THEN {SYSTEM} || '|user=said ' || conv_id || '|assistant=' ELSE CASE WHEN len([x FOR x IN m IF x.role = 'system']) = 0 THEN {SYSTEM} || '|' ELSE '' END || {ROLED} END AS shown FROM n")
def role_content_turns(spark, sf_dir):
    rows = _sometimes(_chats(spark, sf_dir), F.col("messages")).drop("messages").withColumn("text", F.concat(F.lit("said "), F.col("conv_id").cast("string")))
    return convert.convert_rows(rows, "hermes", ["conv_id"]).select("conv_id", _shown(F.col("messages")).alias("shown"))


@query(
    f"""WITH c AS ({CHATS}), n AS (SELECT conv_id, {NO_TURNS} AS m FROM c), t AS (SELECT conv_id, [{{'role': CASE x.role WHEN 'system' THEN 'tool' ELSE x.role END, 'content': x.content}} FOR x IN m] AS m FROM n)
SELECT conv_id, {SYSTEM} || '|' || CASE WHEN m IS NULL OR len(m) = 0 THEN 'user=' || CASE WHEN conv_id % 2 = 0 THEN 'ask ' || conv_id ELSE '{{"conv_id":' || conv_id || ',"query":null,"conversations":' || CASE WHEN m IS NULL THEN 'null' ELSE '[]' END || '}}' END || '|assistant=' ELSE {ROLED} END AS shown FROM t"""
)
def tool_chain_turns(spark, sf_dir):
    other = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").when(r == "system", "observation").otherwise(r)
    turns = F.transform("messages", lambda m: F.struct(other(m["role"]).alias("from"), m["content"].alias("value")))
    rows = _sometimes(_chats(spark, sf_dir), turns).select("conv_id", F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("ask "), F.col("conv_id").cast("string"))).alias("query"), "conversations")
    return convert.convert_rows(rows, "toolbench", ["conv_id"]).select("conv_id", _shown(F.col("messages")).alias("shown"))


@query(f"WITH c AS ({CHATS}) SELECT conv_id, {ROLED} AS shown FROM c")
def message_lists_pass(spark, sf_dir):
    rows = _chats(spark, sf_dir).withColumnRenamed("messages", "conversations")
    return convert.convert_rows(rows, "glaive", ["conv_id"]).select("conv_id", _shown(F.col("messages")).alias("shown"))


@query(
    f"""SELECT event_id, {quoted(domain.SYSTEM_PROMPT)} || CASE event_id % 4 WHEN 0 THEN {quoted(domain.TOOL_SCHEMAS_HEAD)} || '[{{"name": "' || event_type || '"}}]' ELSE '' END AS system, event_type AS asked,
 CASE event_id % 3 WHEN 0 THEN '[{{"name": "' || event_type || '", "n": ' || user_id || '}}]' ELSE {quoted(domain.NO_TOOL_CALL)} END AS answer FROM events"""
)
def function_schemas(spark, sf_dir):
    name = F.concat(F.lit('[{"name": "'), F.col("event_type"), F.lit('"'))
    fourth, third = F.col("event_id") % 4, F.col("event_id") % 3
    tools = F.when(fourth == 0, F.concat(name, F.lit("}]"))).when(fourth == 1, "broken [").when(fourth == 2, "[]")
    made = F.when(third == 0, F.concat(name, F.lit(', "n": '), F.col("user_id").cast("string"), F.lit("}]"))).when(third == 1, "{}")
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("query"), tools.alias("tools"), made.alias("answers"))
    m = F.col("messages")
    return convert.convert_rows(rows, "xlam", ["event_id"]).select("event_id", m[0]["content"].alias("system"), m[1]["content"].alias("asked"), m[2]["content"].alias("answer"))


# ---------------------------------------------------------------- pairs


@query(
    """WITH q AS (SELECT event_id, event_type, (user_id % 6 + coalesce(CASE WHEN event_id % 4 > 0 THEN value / 20 END, 3)) / 2.0 AS quality FROM events)
SELECT event_id, event_type AS prompt, CASE WHEN quality >= 4 THEN event_type ELSE '' END AS chosen, CASE WHEN quality <= 2 THEN event_type ELSE '' END AS rejected, round(quality::DOUBLE, 6) AS quality, true AS needs_pairing FROM q WHERE quality >= 4 OR quality <= 2"""
)
def pairs_from_attributes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("prompt"), F.col("event_type").alias("response"), (F.col("user_id") % 6).alias("helpfulness"), F.when(F.col("event_id") % 4 > 0, F.col("value") / 20).alias("correctness"))
    return _pairs_shown(convert.build_pairs(rows, "helpsteer"), "event_id").withColumns({"quality": F.round("quality", 6)})


def _pairs_shown(rows, key):
    said = lambda n: F.array_join(F.transform(f"pair.{n}", lambda m: m["content"]), "|").alias(n)
    return rows.select(key, said("prompt"), said("chosen"), said("rejected"), "quality", "needs_pairing")


BINARIZED = f"""WITH c AS ({CHATS}), b AS (SELECT conv_id, m, CASE WHEN conv_id % 3 = 0 THEN m WHEN conv_id % 3 = 1 THEN [{{'role': x.role, 'content': x.content || '!'}} FOR x IN m] ELSE [] END AS r FROM c),
 p AS (SELECT conv_id, [x.content FOR x IN m IF x.role <> 'assistant'] AS p, [x.content FOR x IN m IF x.role = 'assistant'] AS c, [x.content FOR x IN r IF x.role = 'assistant'] AS r FROM b WHERE len(r) > 0),
 s AS (SELECT conv_id, array_to_string(CASE WHEN len(p) = 0 THEN ['asked'] ELSE p END, '|') AS prompt, c, r FROM p)"""


def _binarized(spark, sf_dir):
    rows = _chats(spark, sf_dir)
    third = F.col("conv_id") % 3
    louder = F.transform("messages", lambda m: convert.message(m["role"], F.concat(m["content"], F.lit("!"))))
    rejected = F.when(third == 0, F.col("messages")).when(third == 1, louder).otherwise(F.slice("messages", 1, 0))
    return convert.build_pairs(rows.select("conv_id", F.col("messages").alias("chosen"), rejected.alias("rejected"), F.lit("asked").alias("instruction")), "ultrafeedback")


@query(f"{BINARIZED} SELECT conv_id, prompt, array_to_string(c, '|') AS chosen, array_to_string(r, '|') AS rejected, CAST(NULL AS DOUBLE) AS quality, false AS needs_pairing FROM s")
def pairs_from_binarized(spark, sf_dir):
    return _pairs_shown(_binarized(spark, sf_dir), "conv_id")


@query(f"{BINARIZED} SELECT conv_id, array_to_string(list_filter([CASE WHEN len(c) = 0 THEN 'empty_chosen' END, CASE WHEN len(r) = 0 THEN 'empty_rejected' END, CASE WHEN len(c) > 0 AND c = r THEN 'chosen_is_rejected' END], lambda x: x IS NOT NULL), ',') AS errors FROM s")
def pair_errors(spark, sf_dir):
    return convert.validate_pairs(_binarized(spark, sf_dir)).select("conv_id", F.array_join("errors", ",").alias("errors"))


@query("SELECT event_id, event_type AS prompt, CASE WHEN trunc(value / 20) >= 4 THEN props ELSE '' END AS chosen, CASE WHEN trunc(value / 20) <= 2 THEN props ELSE '' END AS rejected, trunc(value / 20)::DOUBLE AS quality, true AS needs_pairing FROM events WHERE trunc(value / 20) >= 4 OR trunc(value / 20) <= 2")
def pairs_from_satisfaction(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "props", (F.col("value") / 20).alias("score"), F.array(convert.message("user", F.col("event_type"))).alias("asked"))
    return _pairs_shown(convert.pairs_from_satisfaction(rows, "props", "score", "asked").where("pair IS NOT NULL"), "event_id")


# ---------------------------------------------------------------- contracts and filters

ERRORS = f"""WITH c AS ({CHATS}), e AS (SELECT conv_id, list_filter([CASE WHEN len(m) < 2 THEN 'messages: too short' END, CASE WHEN len([x FOR x IN m IF x.role = 'user']) = 0 THEN 'messages: no user' END, CASE WHEN len([x FOR x IN m IF x.role = 'assistant']) = 0 THEN 'messages: no assistant' END], lambda x: x IS NOT NULL) AS e FROM c)"""


@query(f"{ERRORS} SELECT conv_id, unnest(e) AS error FROM e")
def chat_contract_errors(spark, sf_dir):
    return quality.validate_dataset(_chats(spark, sf_dir), "chat", "conv_id")[1]


@query(f"{ERRORS}, f AS (SELECT * FROM e ORDER BY conv_id LIMIT 50) SELECT count(*) AS total, CAST(count_if(len(e) = 0) AS BIGINT) AS valid, CAST(count_if(len(e) > 0) AS BIGINT) AS invalid, count_if(len(e) = 0) / count(*) AS valid_ratio FROM f")
def chat_contract_report(spark, sf_dir):
    return quality.validate_dataset(_chats(spark, sf_dir), "chat", "conv_id", first=50)[0]


TICKET_RULES = (("customer_message: too short", "length(text) < 5"), ("urgency: not allowed", "lang = 'fr'"), ("workflow_steps: too short", "doc_id % 7 = 0"), ("confidence: missing", "doc_id % 11 = 0"), ("confidence: out of range", "doc_id % 11 > 9"))


@query(" UNION ALL ".join(f"SELECT doc_id, '{n}' AS error FROM documents WHERE {c}" for n, c in TICKET_RULES))
def ticket_contract_errors(spark, sf_dir):
    eleventh = F.col("doc_id") % 11
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("customer_message"), F.lit("an answer").alias("agent_response"), F.lit("unheard_of").alias("intent"), F.when(F.col("lang") == "fr", "soon").otherwise("low").alias("urgency"),
        F.when(F.col("doc_id") % 7 == 0, F.array().cast("array<string>")).otherwise(F.array("source")).alias("workflow_steps"), F.array("source").alias("tools_required"), F.when(eleventh > 0, eleventh / 9).alias("confidence"),
    )
    return quality.validate_dataset(rows, "annotated_ticket", "doc_id")[1]


FILTERED = f"""WITH a AS (SELECT * FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)), b AS (SELECT * FROM a WHERE {WORDS} BETWEEN 20 AND 2000), c AS (SELECT * FROM b WHERE length(text) > 0 AND {NON_ASCII} < 0.3),
 d AS (SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || ':42'), doc_id) AS r, count(*) OVER () AS n FROM c) WHERE r <= floor(n * 0.05))"""
CHAIN = {"dedup_exact": {}, "filter_length": {"least": 20}, "filter_language": {}, "filter_confidence": {}, "balance_intents": {"column": "source", "share": 0.05}, "ensure_edge_cases": {}}


def _apply_all(spark, sf_dir):
    return quality.apply_all(table(spark, sf_dir, "documents"), CHAIN, key="doc_id")


@query(f"{FILTERED} SELECT doc_id FROM d")
def filter_chain_rows(spark, sf_dir):
    return _apply_all(spark, sf_dir)[0].select("doc_id")


@query(f"""{FILTERED}, n AS (SELECT (SELECT count(*) FROM documents) AS n0, (SELECT count(*) FROM a) AS n1, (SELECT count(*) FROM b) AS n2, (SELECT count(*) FROM c) AS n3, (SELECT count(*) FROM d) AS n4)
SELECT 'dedup_exact' AS stage, n0 AS before, n1 AS after, n0 - n1 AS removed FROM n UNION ALL SELECT 'filter_length', n1, n2, n1 - n2 FROM n UNION ALL SELECT 'filter_language', n2, n3, n2 - n3 FROM n UNION ALL SELECT 'filter_confidence', n3, n3, 0 FROM n UNION ALL SELECT 'balance_intents', n3, n4, n3 - n4 FROM n UNION ALL SELECT 'ensure_edge_cases', n4, n4, 0 FROM n""")
def filter_chain_report(spark, sf_dir):
    return _apply_all(spark, sf_dir)[1].drop("i")


@query("SELECT min(user_id % 50) AS key, event_type AS value, min(c) AS other FROM (SELECT user_id, event_type, min(event_id) OVER (PARTITION BY event_type, user_id % 50) AS c, user_id % 50 = min(user_id % 50) OVER (PARTITION BY event_type) AS first FROM events) WHERE first GROUP BY event_type")
def dedup_repeated_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("key"), F.col("event_type").alias("value"), F.col("event_id").alias("other"))
    return quality.dedup_exact(rows.union(rows), "value", "key")


@query("""WITH e AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings) SELECT vec_id FROM e x WHERE NOT EXISTS (SELECT 1 FROM e y WHERE y.vec_id < x.vec_id AND y.vec_id >= x.vec_id - 300 AND list_cosine_similarity(x.v, y.v) >= 0.4)""")
def dedup_semantic_neighbours(spark, sf_dir):
    return quality.dedup_semantic_neighbours(table(spark, sf_dir, "embeddings"), threshold=0.4, window=300)


@query(
    f"""WITH c AS ({CHATS}), x AS (SELECT conv_id, [{{'role': x.role, 'content': CASE WHEN x.role = 'assistant' AND conv_id % 3 > 0 THEN '{{"intent":"a"' || CASE WHEN conv_id % 3 = 1 THEN ',"response":"b"' ELSE '' END || '}}' ELSE x.content END}} FOR x IN m] AS m FROM c)
SELECT conv_id, len([x FOR x IN m IF x.role = 'system']) > 0 AND len([x FOR x IN m IF x.role = 'user']) > 0 AND len([x FOR x IN m IF x.role = 'assistant']) > 0 AND len([x FOR x IN m IF x.role = 'assistant' AND NOT (json_valid(x.content) AND json_extract(CASE WHEN json_valid(x.content) THEN x.content ELSE '{{}}' END, '$.intent') IS NOT NULL AND json_extract(CASE WHEN json_valid(x.content) THEN x.content ELSE '{{}}' END, '$.response') IS NOT NULL)]) = 0 AS complete FROM x"""
)
def complete_examples(spark, sf_dir):
    third = F.col("conv_id") % 3
    said = F.concat(F.lit('{"intent":"a"'), F.when(third == 1, ',"response":"b"').otherwise(""), F.lit("}"))
    rows = _chats(spark, sf_dir).withColumn("messages", F.transform("messages", lambda m: convert.message(m["role"], F.when((m["role"] == "assistant") & (third > 0), said).otherwise(m["content"]))))
    return rows.select("conv_id", convert.is_complete_example(F.col("messages")).alias("complete"))


# ---------------------------------------------------------------- tickets

TICKETS = f"""t AS (SELECT conv_id, list({{'incoming': CASE role WHEN 'user' THEN true WHEN 'assistant' THEN false END, 'body_text': text}} ORDER BY turn, role, text) AS replies FROM conversations GROUP BY conv_id),
 k AS (SELECT d.doc_id, CASE WHEN d.doc_id % 13 = 0 THEN 'automatisch generierte Nachricht' ELSE text END AS said, lang, doc_id % 5 + 1 AS status, CASE WHEN doc_id % 9 = 0 THEN true WHEN doc_id % 9 < 5 THEN false END AS spam, coalesce(replies, []) AS replies FROM documents d LEFT JOIN t ON conv_id = doc_id % 150),
 w AS (SELECT *, NOT coalesce(spam, false) AND length(regexp_replace(regexp_replace(said, '^\\s+', ''), '\\s+$', '')) >= 20 AND status IN (4, 5) AS single, [x FOR x IN replies IF x.incoming = false] AS agent FROM k)"""


def _tickets(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    packed = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(F.when(t["role"] == "user", True).when(t["role"] == "assistant", False).alias("incoming"), t["text"].alias("body_text")))
    threads = turns.groupBy(F.col("conv_id").alias("at")).agg(packed.alias("conversations"))
    ninth = F.col("doc_id") % 9
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 13 == 0, "automatisch generierte Nachricht").otherwise(F.col("text")).alias("description_text"), F.col("lang").alias("detected_language"), (F.col("doc_id") % 5 + 1).alias("status"), F.when(ninth == 0, True).when(ninth < 5, False).alias("spam"))
    return docs.join(threads, F.col("doc_id") % 150 == F.col("at"), "left").drop("at").withColumns({"subject": F.lit("a subject"), "support_email": F.lit(None).cast("string"), "sentiment_score": F.when(F.col("doc_id") % 2 == 0, 50)})


@query(f"WITH {TICKETS} SELECT count(*) AS tickets, CAST(count_if(single) AS BIGINT) AS single_turn, CAST(count_if(single AND len(agent) > 0 AND length(regexp_replace(regexp_replace(agent[1].body_text, '^\\s+', ''), '\\s+$', '')) >= 20) AS BIGINT) AS with_response, CAST(count_if(single AND len(replies) >= 2) AS BIGINT) AS multi_turn, CAST(count_if(NOT single) AS BIGINT) AS not_usable FROM w")
def ticket_usability(spark, sf_dir):
    return profile.usability(_tickets(spark, sf_dir))


@query(f"WITH {TICKETS}, o AS (SELECT doc_id, said FROM w WHERE status IN (4, 5) AND len(agent) > 0 AND length(regexp_replace(regexp_replace(said, '^\\s+', ''), '\\s+$', '')) > 20 AND lang IN ('en', 'de') AND NOT coalesce(spam, false) AND NOT {sql_any('said', domain.AUTOMATED_PHRASES)}) SELECT min(doc_id) AS doc_id FROM o GROUP BY said")
def organic_tickets(spark, sf_dir):
    return profile.keep_organic(_tickets(spark, sf_dir), ("en", "de"), key="doc_id").select("doc_id")


@query(f"""WITH {TICKETS} SELECT count(*) AS tickets, CAST(count_if(len(replies) = 0) AS BIGINT) AS "none", CAST(count_if(len(replies) = 1) AS BIGINT) AS single, CAST(count_if(len(replies) >= 2) AS BIGINT) AS at_least_2, CAST(count_if(len(replies) >= 5) AS BIGINT) AS at_least_5,
 CAST(count_if(len(replies) >= 10) AS BIGINT) AS at_least_10, CAST(max(len(replies)) AS INTEGER) AS most, avg(len(replies)) AS mean, CAST(count_if(len(agent) > 0) AS BIGINT) AS with_agent, CAST(count_if(len([x FOR x IN replies IF x.incoming]) > 0) AS BIGINT) AS with_follow_up FROM w""")
def ticket_depth(spark, sf_dir):
    return profile.ticket_depth(_tickets(spark, sf_dir))


# ---------------------------------------------------------------- profiles

TAGS = "SELECT event_id, CASE event_id % 4 WHEN 0 THEN [] WHEN 1 THEN NULL WHEN 2 THEN [event_type] ELSE [event_type, 'x'] END AS tags FROM events"


@query(f"WITH t AS ({TAGS}) SELECT CAST(count_if(len(tags) > 0) AS BIGINT) AS with_tags, CAST(count_if(coalesce(len(tags), 0) = 0) AS BIGINT) AS without_tags, (SELECT count(DISTINCT x) FROM (SELECT unnest(tags) AS x FROM t)) AS distinct_tags FROM t")
def tag_counts(spark, sf_dir):
    fourth = F.col("event_id") % 4
    tags = F.when(fourth == 0, F.array().cast("array<string>")).when(fourth == 2, F.array("event_type")).when(fourth == 3, F.array(F.col("event_type"), F.lit("x")))
    return profile.tag_profile(table(spark, sf_dir, "events").select(tags.alias("tags")), "tags")


@query(f"SELECT substr(lower({STRIP}), 1, 50) AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 30")
def top_subjects(spark, sf_dir):
    return profile.top_subjects(table(spark, sf_dir, "documents"), "text")


@query(
    """WITH a AS (SELECT event_type AS i, CASE WHEN user_id % 3 = 0 THEN 'high' ELSE 'low' END AS u, CASE WHEN event_id % 5 > 0 THEN value END AS c, count(*) OVER () AS a FROM events),
 p AS (SELECT 'intent' AS part, i AS value, * EXCLUDE (i, u) FROM a UNION ALL SELECT 'urgency', u, * EXCLUDE (i, u) FROM a UNION ALL SELECT 'all', NULL, * EXCLUDE (i, u) FROM a)
SELECT part, value, count(*) AS n, 100.0::DOUBLE * count(*) / max(a) AS percent, round(avg(c), 6) AS mean_confidence, min(c) AS least_confidence FROM p GROUP BY 1, 2"""
)
def annotation_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumns({"urgency": F.when(F.col("user_id") % 3 == 0, "high").otherwise("low"), "confidence": F.when(F.col("event_id") % 5 > 0, F.col("value"))})
    return profile.annotation_summary(rows, "event_type").withColumn("mean_confidence", F.round("mean_confidence", 6))


@query("WITH c AS (SELECT conv_id, sum(length(text)) AS n FROM conversations GROUP BY conv_id) SELECT CASE WHEN row_number() OVER (ORDER BY md5(conv_id || ':42'), conv_id) - 1 < floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'eval' END AS split, n FROM c".join(("SELECT split, count(*) AS chats, avg(n) AS mean, CAST(min(n) AS BIGINT) AS least, CAST(max(n) AS BIGINT) AS most FROM (", ") GROUP BY split")))
def chat_statistics_by_split(spark, sf_dir):
    return profile.chat_statistics(mix.split(_chats(spark, sf_dir), 0.8, key="conv_id"), split="split")


@query(
    """WITH s AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,}\\b')) AS o, text FROM documents)
SELECT doc_id, CASE WHEN length(o) > 20 THEN substr(o, 1, 20) || '...' ELSE o END AS original, '[EMAIL_REDACTED]' AS replacement FROM s""".replace("\\\\", "\\")
)
def email_detections(spark, sf_dir):
    found = score.detections(table(spark, sf_dir, "documents"), "text", "doc_id").where("type = 'email'")
    return found.select("doc_id", F.when(F.length("original") > 20, F.concat(F.substring("original", 1, 20), F.lit("..."))).otherwise(F.col("original")).alias("original"), "replacement")


# ---------------------------------------------------------------- experiments, mixes and small things


@query("SELECT 'exp' AS experiment, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS variant, event_type AS metric, count(*) AS count, round(avg(value), 4) AS mean, round(min(value), 4) AS min, round(max(value), 4) AS max FROM events GROUP BY ALL")
def experiment_results(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.lit("exp").alias("experiment"), F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("variant"), F.col("event_type").alias("metric"), "value")
    return evaluate.experiment_results(rows)


def _bucket(text: str) -> str:
    part = lambda i: f"CAST('0x' || substr(md5({text}), {1 + 8 * i}, 8) AS BIGINT)"
    return f"(({part(0)} * 36 + {part(1)} * 16 + {part(2)} * 96 + {part(3)}) % 100)"


@query(f"SELECT event_id, CASE WHEN event_type = 'view' AND event_id % 3 > 0 THEN CASE WHEN {_bucket('CAST(user_id AS VARCHAR)')} < 40 THEN 'old' ELSE 'new' END WHEN event_type = 'click' THEN 'clicker' ELSE 'response-gen' END AS adapter FROM events")
def routed_adapters(spark, sf_dir):
    router = evaluate.Router({"click": "clicker", "view": "response-gen"})
    router.register("view", {"a": "old", "b": "new"}, {"a": 0.4, "b": 0.6})
    return table(spark, sf_dir, "events").select("event_id", router.route(F.col("event_type"), F.when(F.col("event_id") % 3 > 0, F.col("user_id"))).alias("adapter"))


@query(
    """WITH r AS (SELECT event_id, event_type, md5(event_id || ':7') AS h, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id || ':7'), event_id) - 1 AS r, count(*) OVER (PARTITION BY event_type) AS n, count(*) OVER () AS a FROM events)
SELECT event_id, event_type AS type FROM r ORDER BY CAST(r >= least(n, greatest(1, floor(40 * n / a))) AS INTEGER), h, event_id LIMIT 40"""
)
def stratified_by_found_column(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("type"))
    return mix.stratified_sample(rows, 40, key="event_id", seed=7)


@query("SELECT doc_id, text AS customer_message, source, 'docs' AS origin FROM documents UNION ALL SELECT page_id, html, NULL, 'pages' FROM pages")
def loaded_mix(spark, sf_dir):
    registry = readers.Registry()
    configs = {"docs": {"id": f"{sf_dir}/documents.parquet", "weight": 0.5, "converter": "bitext"}, "pages": {"loader": "parquet", "path": f"{sf_dir}/pages.parquet", "weight": 0.5}}
    frames = {n: registry.load_source(spark, n, c) for n, c in configs.items()}
    frames["docs"] = frames["docs"].select("doc_id", "customer_message", "source")
    frames["pages"] = frames["pages"].select(F.col("page_id").alias("doc_id"), F.col("html").alias("customer_message"))
    return mix.union_sources(frames, "origin")


@query("""SELECT event_id, user_id AS "a.user_id", event_type AS "a.b.type", value AS "a.b.value" FROM events""")
def flattened_structs(spark, sf_dir):
    nested = F.struct("user_id", F.struct(F.col("event_type").alias("type"), "value").alias("b"))
    return convert.flatten(table(spark, sf_dir, "events").select("event_id", nested.alias("a")))


COLORS = sql_lookup(domain.URGENCY_COLORS, "lower(p)", "#6b7280")


@query(f"SELECT o_orderkey, '<span style=\"background:' || {COLORS} || ';color:white\">' || upper(p) || '</span>' AS badge FROM (SELECT o_orderkey, CASE left(o_orderpriority, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' WHEN '4' THEN 'low' ELSE 'unset' END AS p FROM orders)")
def urgency_badges(spark, sf_dir):
    digit = F.substring("o_orderpriority", 1, 1)
    named = F.when(digit == "1", "Critical").when(digit == "2", "high").when(digit == "3", "medium").when(digit == "4", "low").otherwise("unset")
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.urgency_badge(named).alias("badge"))


@query(
    f"""SELECT event_id, 'Customer message: ' || event_type || CASE WHEN event_id % 2 = 0 THEN chr(10) || 'Agent response: ' || props ELSE '' END AS asked, {SYSTEM} || '|user=' || event_type AS prompt, props AS completion, value > 50 AS label FROM events"""
)
def prompts_and_completions(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("asked", tx.user_prompt(F.col("event_type"), F.when(F.col("event_id") % 2 == 0, F.col("props"))))
    out = convert.completion_rows(rows, "event_type", "props", F.col("value") > 50)
    return out.select("event_id", "asked", _shown(F.col("prompt")).alias("prompt"), "completion", "label")
