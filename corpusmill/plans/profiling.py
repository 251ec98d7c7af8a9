"""Corpus profiles over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import profile
from corpusmill.plans.common import STRIP, sql_any, table
from corpusmill.plans.registry import query
from corpusmill import domain


@query("SELECT coalesce(lang, 'unknown') AS value, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM documents GROUP BY 1")
def language_histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "documents"), "lang")


@query("SELECT coalesce(source, 'unknown') AS value, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM documents GROUP BY 1")
def source_distribution(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "documents"), "source")


@query("SELECT coalesce(o_orderpriority, 'unknown') AS value, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM orders GROUP BY 1")
def priority_histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT coalesce(o_orderstatus, 'unknown') AS value, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent FROM orders GROUP BY 1")
def status_histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    """WITH e AS (SELECT conv_id, count(*) AS n, bool_or(role = 'assistant') AS a, bool_or(role = 'user') AS u FROM conversations GROUP BY conv_id)
SELECT count(*) AS conversations, CAST(count_if(n = 1) AS BIGINT) AS single, CAST(count_if(n >= 2) AS BIGINT) AS at_least_2, CAST(count_if(n >= 5) AS BIGINT) AS at_least_5, CAST(count_if(n >= 10) AS BIGINT) AS at_least_10,
 max(n) AS most, avg(n) AS mean, CAST(count_if(a) AS BIGINT) AS with_agent, CAST(count_if(u) AS BIGINT) AS with_user FROM e"""
)
def conversation_depth(spark, sf_dir):
    return profile.depth(table(spark, sf_dir, "conversations"))


@query("SELECT n AS turns, count(*) AS conversations FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id) GROUP BY n")
def conversation_depth_histogram(spark, sf_dir):
    each = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    return each.groupBy("turns").agg(F.count(F.lit(1)).alias("conversations"))


@query(
    f"""WITH u AS (SELECT length(text) AS n FROM documents WHERE length({STRIP}) >= 5)
SELECT count(*) AS texts, CAST(min(n) AS INTEGER) AS least, CAST(max(n) AS INTEGER) AS most, avg(n) AS mean, CAST(count_if(n < 50) AS BIGINT) AS under_50, CAST(count_if(n >= 50 AND n < 500) AS BIGINT) AS under_500,
 CAST(count_if(n >= 500 AND n < 2000) AS BIGINT) AS under_2000, CAST(count_if(n >= 2000) AS BIGINT) AS longer, CAST(list_sort(list(n))[(count(*) // 2) + 1] AS INTEGER) AS median FROM u"""
)
def message_lengths(spark, sf_dir):
    return profile.length_stats(table(spark, sf_dir, "documents"), "text")


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def top_tags(spark, sf_dir):
    return profile.top_tags(table(spark, sf_dir, "events").select(F.array("event_type").alias("tags")), "tags", 3)


@query(
    "SELECT avg(value) AS mean, min(value) AS least, max(value) AS most, "
    + ", ".join(f"CAST(count_if(value BETWEEN {a} AND {b}) AS BIGINT) AS from_{a}_to_{b}" for a, b in ((0, 20), (21, 40), (41, 60), (61, 80), (81, 100)))
    + " FROM (SELECT CAST(round(value) AS DOUBLE) AS value FROM events WHERE value IS NOT NULL)"
)
def sentiment_buckets(spark, sf_dir):
    return profile.value_buckets(table(spark, sf_dir, "events").select(F.round("value").alias("value")), "value")


@query(
    """WITH t AS (SELECT strftime(ts, '%Y-%m') AS m, strftime(ts, '%A') AS d, CAST(hour(ts) AS VARCHAR) AS h FROM events)
SELECT 'month' AS unit, m AS value, count(*) AS n FROM t GROUP BY m UNION ALL SELECT 'weekday', d, count(*) FROM t GROUP BY d UNION ALL SELECT 'hour', h, count(*) FROM t GROUP BY h"""
)
def time_profile(spark, sf_dir):
    return profile.time_profile(table(spark, sf_dir, "events"), "ts")


@query(f"WITH g AS (SELECT substr(lower({STRIP}), 1, 50) AS s, count(*) AS n, sum(length(text)) AS l FROM documents GROUP BY 1) SELECT count(*) AS distinct_subjects, sum(l) / sum(n) AS mean_length, CAST(count_if(n >= 5) AS BIGINT) AS repeated_5_plus FROM g")
def subject_profile(spark, sf_dir):
    return profile.subject_profile(table(spark, sf_dir, "documents"), "text")


@query(f"SELECT CAST(count_if({sql_any('text', domain.AUTOMATED_PHRASES)} OR l.doc_id IS NULL) AS BIGINT) AS likely_automated, CAST(count_if(NOT ({sql_any('text', domain.AUTOMATED_PHRASES)} OR l.doc_id IS NULL)) AS BIGINT) AS likely_human FROM documents d LEFT JOIN labels l USING (doc_id)")
def automated_tickets(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("replies"))
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id", "left").fillna(0, ["replies"])
    auto = profile.is_automated(F.col("text"), F.lit("a subject"), F.lit(None).cast("string"), F.col("replies"), F.lit(None).cast("int"))
    return rows.agg(F.count_if(auto).alias("likely_automated"), F.count_if(~auto).alias("likely_human"))


@query("SELECT 'k' AS field, count(*) AS present, CAST(count_if(trim(json_extract_string(props, '$.k')) <> '') AS BIGINT) AS filled FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def custom_field_fill(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.from_json("props", "map<string,string>").alias("fields"))
    return profile.field_fill(events, "fields")


@query("WITH c AS (SELECT conv_id, sum(length(text)) AS n FROM conversations GROUP BY conv_id) SELECT count(*) AS chats, avg(n) AS mean, CAST(min(n) AS BIGINT) AS least, CAST(max(n) AS BIGINT) AS most FROM c")
def chat_sizes(spark, sf_dir):
    from corpusmill.operators import convert

    size = F.aggregate("messages", F.lit(0).cast("long"), lambda s, m: s + F.length(m["content"]))
    chats = convert.threads(table(spark, sf_dir, "conversations")).select(size.alias("n"))
    return chats.agg(F.count(F.lit(1)).alias("chats"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"))


@query("SELECT CAST(count_if(n >= 20) AS BIGINT) AS with_text, CAST(count_if(quality = 1) AS BIGINT) AS resolved, CAST(count_if(n >= 20 AND quality = 1 AND toxic = 0) AS BIGINT) AS usable FROM (SELECT length(text) AS n, quality, toxic FROM documents JOIN labels USING (doc_id))")
def usable_tickets(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    long, good = F.length("text") >= 20, F.col("quality") == 1
    return rows.agg(F.count_if(long).alias("with_text"), F.count_if(good).alias("resolved"), F.count_if(long & good & (F.col("toxic") == 0)).alias("usable"))


@query("SELECT 'documents' AS name, count(*) AS num_examples, 'doc_id,text,lang,source,n_chars' AS columns FROM documents")
def source_metadata(spark, sf_dir):
    return profile.metadata(table(spark, sf_dir, "documents"), "documents").select("name", "num_examples", F.array_join("columns", ",").alias("columns"))
