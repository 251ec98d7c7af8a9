"""Filters, dedup, sampling, mixing and conversion over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators import convert, mix, quality
from corpusmill.plans.common import NON_ASCII, WORDS, quoted, sql_any, sql_lookup, table
from corpusmill.plans.registry import query
from corpusmill.sources import readers

FIRSTS = "SELECT min(doc_id) FROM documents GROUP BY md5(coalesce(text, 'None'))"


@query(f"SELECT lang, count(*) AS n FROM documents WHERE {WORDS} BETWEEN 10 AND 2000 AND length(text) > 0 AND {NON_ASCII} < 0.3 AND doc_id IN ({FIRSTS.replace('FROM documents', f'FROM documents WHERE {WORDS} BETWEEN 10 AND 2000 AND {NON_ASCII} < 0.3')}) GROUP BY lang")
def quality_by_lang(spark, sf_dir):
    kept = quality.dedup_exact(quality.filter_language(quality.filter_length(table(spark, sf_dir, "documents"))))
    return kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, CAST({WORDS} AS INTEGER) AS n_words, {NON_ASCII} AS non_ascii FROM documents WHERE {WORDS} BETWEEN 10 AND 2000 AND length(text) > 0 AND {NON_ASCII} < 0.3")
def filter_length_language(spark, sf_dir):
    kept = quality.filter_language(quality.filter_length(table(spark, sf_dir, "documents")))
    return kept.select("doc_id", tx.word_count(F.col("text")).alias("n_words"), tx.non_ascii_share(F.col("text")).alias("non_ascii"))


@query("SELECT doc_id, CAST(quality AS DOUBLE) AS quality FROM labels WHERE quality >= 0.8")
def filter_confidence(spark, sf_dir):
    return quality.filter_at_least(table(spark, sf_dir, "labels"), "quality", 0.8).select("doc_id", F.col("quality").cast("double").alias("quality"))


@query("SELECT doc_id FROM documents WHERE lang = 'en'")
def filter_language_equal(spark, sf_dir):
    return quality.filter_equal(table(spark, sf_dir, "documents"), "lang", "en").select("doc_id")


@query("SELECT avg(CAST(event_type IN ('error', 'signup') AS DOUBLE)) AS edge_share FROM events")
def edge_case_share(spark, sf_dir):
    return quality.edge_case_share(table(spark, sf_dir, "events"), "event_type", ("error", "signup"))


@query(
    f"""WITH f AS (SELECT {WORDS} BETWEEN 10 AND 2000 AS a, length(text) > 0 AND {NON_ASCII} < 0.3 AS b, lang = 'en' AS c FROM documents),
 n AS (SELECT count(*) AS c0, CAST(count_if(a) AS BIGINT) AS c1, CAST(count_if(a AND b) AS BIGINT) AS c2, CAST(count_if(a AND b AND c) AS BIGINT) AS c3 FROM f)
SELECT 'length' AS stage, c0 AS before, c1 AS after, c0 - c1 AS removed FROM n UNION ALL SELECT 'ascii', c1, c2, c1 - c2 FROM n UNION ALL SELECT 'english', c2, c3, c2 - c3 FROM n"""
)
def filter_stage_report(spark, sf_dir):
    text = F.col("text")
    stages = [("length", tx.word_count(text).between(10, 2000)), ("ascii", (F.length(text) > 0) & (tx.non_ascii_share(text) < 0.3)), ("english", F.col("lang") == "en")]
    return quality.filter_report(table(spark, sf_dir, "documents"), stages)


@query(f"SELECT doc_id, lang, source FROM documents WHERE doc_id IN ({FIRSTS})")
def dedup_exact_text(spark, sf_dir):
    return quality.dedup_exact(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source")


@query()
def dedup_semantic_greedy(spark, sf_dir):
    return quality.dedup_semantic(table(spark, sf_dir, "embeddings"), threshold=0.4)


CHATS = "SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn, role, text) AS m FROM conversations GROUP BY conv_id"


@query(f"WITH c AS ({CHATS}), h AS (SELECT conv_id, md5(array_to_string([x.role || ':' || x.content FOR x IN m IF x.role <> 'system'], '|')) AS h FROM c) SELECT min(conv_id) AS conv_id FROM h GROUP BY h")
def dedup_chat_messages(spark, sf_dir):
    return convert.dedup_messages(convert.threads(table(spark, sf_dir, "conversations"))).select("conv_id")


@query(f"WITH c AS ({CHATS}) SELECT conv_id, CAST(len(m) AS INTEGER) AS n, array_to_string(['<|im_start|>' || x.role || chr(10) || coalesce(x.content, '') || '<|im_end|>' FOR x IN m], chr(10)) AS rendered FROM c")
def chat_template(spark, sf_dir):
    chats = convert.threads(table(spark, sf_dir, "conversations"))
    return chats.select("conv_id", F.size("messages").alias("n"), convert.render(F.col("messages")).alias("rendered"))


@query(
    f"""WITH c AS ({CHATS}) SELECT conv_id, [x.content FOR x IN m IF x.role = 'user'][-1] AS last_user FROM c
WHERE len(m) >= 2 AND len([x FOR x IN m IF x.role = 'user']) > 0 AND len([x FOR x IN m IF x.role = 'assistant' AND trim(x.content) <> '']) > 0"""
)
def valid_dialogues(spark, sf_dir):
    chats = convert.threads(table(spark, sf_dir, "conversations")).where(convert.has_dialogue(F.col("messages")))
    return chats.select("conv_id", convert.last_user(F.col("messages")).alias("last_user"))


@query("WITH n AS (SELECT floor(count(*) * 0.3) AS cap FROM events), r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id || ':42'), event_id) AS r FROM events) SELECT event_id, event_type FROM r, n WHERE r <= cap")
def balance_classes(spark, sf_dir):
    return quality.balance_classes(table(spark, sf_dir, "events"), "event_type").select("event_id", "event_type")


WEIGHTS = {"src0": 0.5, "src1": 0.3, "src2": 0.2}
MIX = """r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents WHERE source IN ('src0', 'src1', 'src2')),
 t AS (SELECT *, CASE source WHEN 'src0' THEN 150 WHEN 'src1' THEN 90 ELSE 60 END AS t FROM r),
 m AS (SELECT doc_id, source, CAST(copy AS BIGINT) AS copy FROM (SELECT *, unnest(range(0, 1000)) AS copy FROM t) WHERE copy * n + r < t)"""


@query(f"WITH {MIX} SELECT * FROM m")
def mix_weighted_sources(spark, sf_dir):
    return mix.mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, 300).select("doc_id", "source", "copy")


@query(f"WITH {MIX} SELECT source, count(*) AS n, count(*) / sum(count(*)) OVER () AS actual, CASE source WHEN 'src0' THEN 0.5::DOUBLE WHEN 'src1' THEN 0.3::DOUBLE ELSE 0.2::DOUBLE END AS target FROM m GROUP BY source")
def mix_composition(spark, sf_dir):
    return mix.composition(mix.mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, 300), WEIGHTS)


@query("WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS r FROM documents) SELECT doc_id, source FROM r WHERE r < CASE source WHEN 'src0' THEN 15 WHEN 'src1' THEN 9 WHEN 'src2' THEN 6 END")
def subsample_sources(spark, sf_dir):
    return mix.subsample(table(spark, sf_dir, "documents"), WEIGHTS, 30).select("doc_id", "source")


@query(
    """WITH r AS (SELECT doc_id, lang, md5(doc_id || ':42') AS h, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n, count(*) OVER () AS a FROM documents)
SELECT doc_id, lang FROM r ORDER BY CAST(r >= least(n, greatest(1, floor(100 * n / a))) AS INTEGER), h, doc_id LIMIT 100"""
)
def stratified_sample(spark, sf_dir):
    return mix.stratified_sample(table(spark, sf_dir, "documents"), 100, column="lang", key="doc_id").select("doc_id", "lang")


@query("SELECT doc_id FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 50")
def random_sample(spark, sf_dir):
    return mix.random_sample(table(spark, sf_dir, "documents"), 50, key="doc_id").select("doc_id")


@query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1 < floor(count(*) OVER () * 0.9) THEN 'train' ELSE 'eval' END AS split FROM documents")
def train_eval_split(spark, sf_dir):
    return mix.split(table(spark, sf_dir, "documents"), 0.9, key="doc_id").select("doc_id", "split")


@query("SELECT doc_id AS id, text AS customer_message, lang AS language, CAST(NULL AS VARCHAR) AS url FROM documents UNION ALL BY NAME SELECT page_id AS id, html AS customer_message, CAST(NULL AS VARCHAR) AS language, url FROM pages")
def union_with_aliases(spark, sf_dir):
    docs = readers.normalize_columns(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language")))
    pages = readers.normalize_columns(table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("body"), "url"))
    return mix.union_sources({"documents": docs, "pages": pages}).drop("source")


def _urgency_sql(base: str) -> str:
    return f"CASE WHEN {sql_any('text', domain.CRITICAL_WORDS)} THEN 'critical' WHEN {sql_any('text', domain.URGENT_WORDS)} THEN CASE {base} WHEN 'low' THEN 'medium' WHEN 'medium' THEN 'high' ELSE {base} END ELSE {base} END"


CATEGORIES = list(domain.CATEGORY_INTENT)
CATEGORY = f"CASE CAST(doc_id % {len(CATEGORIES)} AS VARCHAR) " + " ".join(f"WHEN '{i}' THEN {quoted(c)}" for i, c in enumerate(CATEGORIES)) + " END"


@query(f"WITH d AS (SELECT *, {CATEGORY} AS category FROM documents) SELECT doc_id, {sql_lookup(domain.CATEGORY_INTENT, 'category', 'general_inquiry')} AS intent, {_urgency_sql('(' + sql_lookup(domain.CATEGORY_URGENCY, 'category', 'medium') + ')')} AS urgency, text AS user_message FROM d")
def convert_category_tickets(spark, sf_dir):
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.col("doc_id") % len(CATEGORIES) + 1).cast("int"))
    rows = convert.from_category(table(spark, sf_dir, "documents").withColumn("category", category).withColumnRenamed("text", "instruction"))
    return rows.select("doc_id", F.col("intent_out").alias("intent"), F.col("urgency_out").alias("urgency"), F.col("messages")[1]["content"].alias("user_message"))


QUEUES = list(domain.QUEUE_INTENT)
QUEUE = f"CASE CAST(o_orderkey % {len(QUEUES)} AS VARCHAR) " + " ".join(f"WHEN '{i}' THEN {quoted(c)}" for i, c in enumerate(QUEUES)) + " END"
PRIORITY = "CASE left(o_orderpriority, 1) WHEN '1' THEN 'high' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' WHEN '5' THEN 'low' ELSE 'unset' END"


@query(f"WITH d AS (SELECT o_orderkey, {QUEUE} AS queue, {PRIORITY} AS priority FROM orders) SELECT o_orderkey, {sql_lookup(domain.QUEUE_INTENT, 'queue', 'general_inquiry')} AS intent, CASE WHEN priority IN ('high', 'medium', 'low') THEN priority ELSE 'medium' END AS urgency FROM d")
def convert_queue_tickets(spark, sf_dir):
    queue = F.element_at(F.array(*map(F.lit, QUEUES)), (F.col("o_orderkey") % len(QUEUES) + 1).cast("int"))
    digit = F.substring("o_orderpriority", 1, 1)
    priority = F.when(digit.isin("1", "2"), "high").when(digit == "3", "medium").when(digit == "5", "low").otherwise("unset")
    rows = convert.from_queue(table(spark, sf_dir, "orders").select("o_orderkey", queue.alias("queue"), priority.alias("priority"), F.lit("").alias("body")))
    return rows.select("o_orderkey", F.col("intent_out").alias("intent"), F.col("urgency_out").alias("urgency"))


@query("SELECT doc_id, 'short_message' AS error FROM documents WHERE length(text) < 100 UNION ALL SELECT doc_id, 'foreign' FROM documents WHERE lang <> 'en'")
def validate_contract(spark, sf_dir):
    bad = quality.validate_rows(table(spark, sf_dir, "documents"), {"short_message": F.length("text") >= 100, "foreign": F.col("lang") == "en"}, "doc_id")
    return bad.select("doc_id", F.explode("errors").alias("error"))


@query("SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_unfinished(spark, sf_dir):
    return readers.unfinished(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id")
