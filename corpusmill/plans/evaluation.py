"""Metrics, audits, preference pairs and experiments over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import evaluate
from corpusmill.plans.common import quoted, sql_count, table
from corpusmill.plans.registry import query
from corpusmill.sources import readers

PRED = "CASE WHEN substr(md5(CAST(event_id AS VARCHAR)), 1, 1) IN ('0', '1', '2', '3') THEN 'view' ELSE event_type END"


def labelled(spark, sf_dir):
    pred = F.when(F.substring(F.md5(F.col("event_id").cast("string")), 1, 1).isin("0", "1", "2", "3"), "view").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").withColumn("pred", pred)


SCORES = f"""e AS (SELECT event_type AS g, {PRED} AS p FROM events), l AS (SELECT DISTINCT unnest([g, p]) AS label FROM e),
 c AS (SELECT label, count_if(g = label AND p = label) AS tp, count_if(g = label) AS gold, count_if(p = label) AS pred FROM l, e GROUP BY label),
 s AS (SELECT label, CASE WHEN pred = 0 THEN 0 ELSE tp / pred END::DOUBLE AS precision, CASE WHEN gold = 0 THEN 0 ELSE tp / gold END::DOUBLE AS recall, CASE WHEN pred + gold = 0 THEN 0 ELSE 2.0 * tp / (pred + gold) END::DOUBLE AS f1, tp, gold FROM c)"""


@query(f"WITH {SCORES} SELECT label, precision, recall, f1 FROM s")
def intent_class_scores(spark, sf_dir):
    return evaluate.class_scores(labelled(spark, sf_dir), "pred", "event_type").drop("gold")


@query(f"WITH {SCORES} SELECT round((sum(tp) / sum(gold))::DOUBLE, 9) AS micro_f1, round(avg(f1), 9) AS macro_f1 FROM s")
def intent_f1(spark, sf_dir):
    out = evaluate.f1_summary(labelled(spark, sf_dir), "pred", "event_type")
    return out.select(F.round("micro_f1", 9).alias("micro_f1"), F.round("macro_f1", 9).alias("macro_f1"))


@query(f"SELECT avg(CASE WHEN {PRED} = event_type THEN 1.0::DOUBLE ELSE 0.0 END) AS accuracy FROM events")
def decision_accuracy(spark, sf_dir):
    return labelled(spark, sf_dir).agg(F.avg(F.when(F.col("pred") == F.col("event_type"), 1.0).otherwise(0.0)).alias("accuracy"))


LISTS = """l AS (SELECT user_id, list(event_type ORDER BY event_id) AS g, coalesce(list(event_type ORDER BY event_id) FILTER (value > 40), []) AS p FROM events GROUP BY user_id)"""


def lists(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    pack = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("event_id", c))), lambda x: x[c])
    kept = F.when(F.col("value") > 40, F.col("event_type")).alias("t")
    out = rows.withColumn("t", kept).groupBy("user_id").agg(pack("event_type").alias("gold"), pack("t").alias("p"))
    return out.select("user_id", "gold", F.filter("p", lambda x: x.isNotNull()).alias("pred"))


# an arrow of one byte here: DuckDB's levenshtein counts bytes
@query(
    f"""WITH {LISTS}, x AS (SELECT array_to_string(p, ' > ') AS a, array_to_string(g, ' > ') AS b, len(list_intersect(list_distinct(p), list_distinct(g))) AS i, len(list_distinct(p)) AS np, len(list_distinct(g)) AS ng, len(g) AS n, len(list_distinct(list_concat(p, g))) AS u,
  array_to_string([substr(t, 1, 1) FOR t IN p], '') AS pc, array_to_string([substr(t, 1, 1) FOR t IN g], '') AS gc FROM l)
SELECT round(avg(1 - levenshtein(a, b) / greatest(length(a), length(b))), 9) AS joined_distance, round(avg(CASE WHEN pc = '' THEN 0.0 ELSE 1 - levenshtein(pc, gc) / greatest(length(pc), length(gc)) END), 9) AS token_distance, round(avg(i / n), 9) AS overlap, round((2.0 * sum(i) / sum(np + ng))::DOUBLE, 9) AS micro_f1,
 round(avg(CASE WHEN np = 0 THEN 0.0 ELSE i / np END), 9) AS macro_precision, round(avg(i / ng), 9) AS macro_recall, round(avg(2.0::DOUBLE * i / (np + ng)), 9) AS macro_f1, round(avg(i / u), 9) AS jaccard FROM x"""
)
def workflow_and_tool_metrics(spark, sf_dir):
    out = evaluate.list_metrics(lists(spark, sf_dir), "pred", "gold")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query(f"WITH {LISTS}, m AS (SELECT user_id, array_to_string(list_sort(list_distinct([x FOR x IN g IF NOT list_contains(p, x)])), ',') AS missing FROM l) SELECT * FROM m WHERE missing <> ''")
def tool_mismatches(spark, sf_dir):
    return evaluate.mismatches(lists(spark, sf_dir), "pred", "gold", "user_id").select("user_id", F.array_join("missing", ",").alias("missing"))


@query("SELECT quantile_cont(value, 0.5) AS p50, list_sort(list(value))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95, count(*) AS n FROM events WHERE value > 0")
def latency_percentiles(spark, sf_dir):
    return evaluate.latency(table(spark, sf_dir, "events"), "value")


@query("WITH a AS (SELECT event_type AS metric, avg(value) AS base FROM events WHERE event_id % 2 = 0 GROUP BY 1), b AS (SELECT event_type AS metric, avg(value) AS tuned FROM events WHERE event_id % 2 = 1 GROUP BY 1) SELECT metric, round(base, 9) AS base, round(tuned, 9) AS tuned, CASE WHEN abs(tuned - base) < 0.001 THEN 'unchanged' WHEN tuned > base THEN 'improvement' ELSE 'regression' END AS change FROM a JOIN b USING (metric)")
def compare_models(spark, sf_dir):
    means = lambda r: table(spark, sf_dir, "events").where(f"event_id % 2 = {r}").groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    out = evaluate.compare_runs(means(0), means(1))
    return out.select("metric", F.round("base", 9).alias("base"), F.round("tuned", 9).alias("tuned"), "change")


@query("SELECT event_type AS metric, round(avg(value) FILTER (user_id % 2 = 0), 9) AS even, round(avg(value) FILTER (user_id % 2 = 1), 9) AS odd FROM events GROUP BY 1")
def comparison_grid(spark, sf_dir):
    system = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric"), system.alias("system")).agg(F.avg("value").alias("value"))
    return readers.comparison_grid(rows, ["even", "odd"]).select("metric", F.round("even", 9).alias("even"), F.round("odd", 9).alias("odd"))


SIGNALS = {"en": (("the", "of", "and", "to"), ("une", "der")), "fr": (("le", "la", "des", "qui"), ("the",)), "de": (("der", "die", "und", "das"), ("the",)), "es": (("el", "los", "las", "que"), ("the", "qui"))}
SCORED = ", ".join(f"{{'s': {sql_count('text', yes)} - 2 * {sql_count('text', no)}, 'i': {-i}, 'c': {quoted(n)}}}" for i, (n, (yes, no)) in enumerate(SIGNALS.items()))
HINT = f"list_max(list_filter([{SCORED}], lambda x: x.s > 0)).c"


@query(f"SELECT doc_id, {HINT} AS hint FROM documents")
def keyword_classes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", evaluate.likely_class(F.col("text"), SIGNALS).alias("hint"))


@query(f"WITH d AS (SELECT doc_id, lang, CASE doc_id % 3 WHEN 0 THEN 'en' ELSE 'fr' END AS pred, {HINT} AS hint FROM documents) SELECT CASE WHEN hint = pred THEN 'relabel' WHEN hint IS NULL THEN 'add_secondary' ELSE 'keep_gold' END AS action, count(*) AS n FROM d WHERE pred <> lang GROUP BY 1")
def gold_audit(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("pred", F.when(F.col("doc_id") % 3 == 0, "en").otherwise("fr")).withColumn("hint", evaluate.likely_class(F.col("text"), SIGNALS))
    return evaluate.audit_labels(rows, "pred", "lang", "hint").groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS b, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS w FROM events)
SELECT user_id, max(event_id) FILTER (b = 1) AS chosen, max(event_id) FILTER (w = 1) AS rejected FROM r GROUP BY user_id HAVING count(*) >= 2 AND max(value) - min(value) >= 0.5"""
)
def preference_pairs(spark, sf_dir):
    return evaluate.best_and_worst(table(spark, sf_dir, "events"), "user_id", "event_id", "event_id", "value")


@query("SELECT event_id, CASE WHEN trunc(value / 20) >= 4 THEN 'chosen' WHEN trunc(value / 20) <= 2 THEN 'rejected' END AS side FROM events")
def preference_by_score(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", evaluate.by_score((F.col("value") / 20).cast("int")).alias("side"))


def _bucket(text: str) -> str:
    part = lambda i: f"CAST('0x' || substr(md5({text}), {1 + 8 * i}, 8) AS BIGINT)"
    return f"(({part(0)} * 36 + {part(1)} * 16 + {part(2)} * 96 + {part(3)}) % 100)"


@query(f"SELECT DISTINCT user_id, CASE WHEN {_bucket(chr(39) + 'exp:' + chr(39) + ' || user_id')} < 30 THEN 'a' ELSE 'b' END AS variant, CASE WHEN {_bucket('CAST(user_id AS VARCHAR)')} < 50 THEN 'a' ELSE 'b' END AS routed FROM events")
def experiment_variants(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select("user_id", evaluate.assign_variant("exp", F.col("user_id"), {"a": 0.3, "b": 0.7}).alias("variant"), evaluate.assign_variant(None, F.col("user_id"), {"a": 0.5, "b": 0.5}).alias("routed"))


@query(f"WITH e AS (SELECT CASE WHEN {_bucket(chr(39) + 'exp:' + chr(39) + ' || user_id')} < 30 THEN 'a' ELSE 'b' END AS variant, event_type, value FROM events) SELECT variant, event_type, count(*) AS n, round(avg(value), 9) AS mean, min(value) AS least, max(value) AS most, round(var_samp(value), 6) AS variance FROM e GROUP BY ALL")
def experiment_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("variant", evaluate.assign_variant("exp", F.col("user_id"), {"a": 0.3, "b": 0.7}))
    out = evaluate.variant_summary(rows, "variant", "event_type", "value")
    return out.withColumns({"mean": F.round("mean", 9), "variance": F.round("variance", 6)})


@query("WITH j AS (SELECT json_extract(props, '$.k') AS k FROM events) SELECT CAST(count_if(k IS NOT NULL) AS BIGINT) AS parsed, round(avg(CAST(k AS DOUBLE)), 9) AS mean FROM j")
def strict_json(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(tx.json_field(tx.strict_json(F.col("props")), "k", "double").alias("k"))
    return rows.agg(F.count_if(F.col("k").isNotNull()).alias("parsed"), F.round(F.avg("k"), 9).alias("mean"))
