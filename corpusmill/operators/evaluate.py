"""Metrics against gold labels, audits, preference pairs and experiments."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as tx


def class_scores(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """(label, precision, recall, f1) over the labels in gold and predictions; 0 where undefined.

    Pairs are counted first, so that what is exploded has a row for each pair of labels only.
    """
    pairs = df.groupBy(F.col(pred).alias("p"), F.col(gold).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("g").alias("label"), F.lit(0).alias("side")), F.struct(F.col("p").alias("label"), F.lit(1).alias("side")))).alias("s"), "n", (F.col("p") == F.col("g")).alias("hit"))
    sums = sides.groupBy(F.col("s.label").alias("label")).agg(
        F.sum(F.when((F.col("s.side") == 0) & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("s.side") == 0, F.col("n")).otherwise(0)).alias("gold"),
        F.sum(F.when(F.col("s.side") == 1, F.col("n")).otherwise(0)).alias("pred"),
    )
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    tp, g, p = F.col("tp"), F.col("gold"), F.col("pred")
    return sums.select("label", ratio(tp, p).alias("precision"), ratio(tp, g).alias("recall"), ratio(2.0 * tp, p + g).alias("f1"), "gold")


def f1_summary(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """micro (the accuracy) and macro F1."""
    scores = class_scores(df, pred, gold)
    return scores.agg((F.sum(F.col("recall") * F.col("gold")) / F.sum("gold")).alias("micro_f1"), F.avg("f1").alias("macro_f1"))


def list_metrics(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """Every definition of list agreement in use: two edit distances, overlap, micro and macro F1, Jaccard."""
    p, g = F.col(pred), F.col(gold)
    both = F.size(F.array_intersect(p, g))
    np_, ng = F.size(F.array_distinct(p)), F.size(F.array_distinct(g))
    part = lambda n: F.when(n == 0, (np_ + ng == 0).cast("double")).otherwise(both / n)
    return df.agg(
        F.avg(tx.joined_distance_score(p, g)).alias("joined_distance"),
        F.avg(tx.token_distance_score(p, g)).alias("token_distance"),
        F.avg(F.when(F.size(g) == 0, 0.0).otherwise(both / F.size(g))).alias("overlap"),
        (F.when(F.sum(np_ + ng) > 0, 2.0 * F.sum(both) / F.sum(np_ + ng)).otherwise(0.0)).alias("micro_f1"),
        F.avg(part(np_)).alias("macro_precision"),
        F.avg(part(ng)).alias("macro_recall"),
        F.avg(tx.set_f1(p, g)).alias("macro_f1"),
        F.avg(tx.jaccard(p, g)).alias("jaccard"),
    )


def workflow_scores(df: DataFrame, pred: str, gold: str, key: str) -> DataFrame:
    """(key, accuracy): the agreement of two step lists by edit distance, to 4 digits a row."""
    return df.select(key, F.round(tx.joined_distance_score(F.col(pred), F.col(gold)), 4).alias("accuracy"))


def workflow_accuracy(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """One row, mean_accuracy: the mean, to 4 digits, of the rows' agreement to 4 digits; 0 without rows."""
    each = F.round(tx.joined_distance_score(F.col(pred), F.col(gold)), 4)
    return df.agg(F.round(F.coalesce(F.avg(each), F.lit(0.0)), 4).alias("mean_accuracy"))


def tool_set_scores(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """Micro precision, recall and F1 of two lists as sets, over all rows, to 4 digits; 0 where undefined."""
    both, p, g = F.size(F.array_intersect(pred, gold)), F.size(F.array_distinct(pred)), F.size(F.array_distinct(gold))
    one = df.agg(F.coalesce(F.sum(both), F.lit(0)).alias("b"), F.coalesce(F.sum(p), F.lit(0)).alias("p"), F.coalesce(F.sum(g), F.lit(0)).alias("g"))
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    b, p, g = F.col("b"), F.col("p"), F.col("g")
    return one.select(F.round(ratio(b, p), 4).alias("precision"), F.round(ratio(b, g), 4).alias("recall"), F.round(ratio(2.0 * b, p + g), 4).alias("f1"))


def decision_accuracy(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """One row, accuracy: the share of rows whose prediction is the gold value, to 4 digits; 0 without rows."""
    return df.agg(F.round(F.coalesce(F.avg(F.coalesce(F.col(pred) == F.col(gold), F.lit(False)).cast("double")), F.lit(0.0)), 4).alias("accuracy"))


def mismatches(df: DataFrame, pred: str, gold: str, key: str) -> DataFrame:
    """Rows whose lists differ, with what is missing and what is extra."""
    out = df.select(key, F.array_sort(F.array_except(gold, pred)).alias("missing"), F.array_sort(F.array_except(pred, gold)).alias("extra"))
    return out.where((F.size("missing") > 0) | (F.size("extra") > 0))


def latency(df: DataFrame, column: str, buckets: int = 4096) -> DataFrame:
    """p50 (interpolated) and p95 (the element at ``int(n * .95)``, from 0) of the values over 0.

    Counts by equal ranges of the values say which range holds a place; only its values are
    ordered.  Nulls, infinite values and NaN take no part; without values all are null and n is 0.
    """
    spark = df.sparkSession
    over = df.select(F.col(column).cast("double").alias("v")).where(F.col("v") > 0).where(F.col("v") < math.inf)

    def at(places: list[int]) -> dict[int, float]:
        """The values at these places of the order."""
        found, todo = {}, [(p, p, None, None) for p in places]
        while todo:
            place, rest, low, high = todo.pop()
            part = over if low is None else over.where(F.col("v").between(low, high))
            n, least, most = part.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
            if least == most:
                found[place] = least
                continue
            wide = (most - least) / buckets
            bucket = F.least(F.floor((F.col("v") - F.lit(least)) / F.lit(wide)), F.lit(buckets - 1)) if wide > 0 else F.when(F.col("v") == least, 0).otherwise(1)
            rows = part.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("b").collect()
            for r in rows:
                if rest < r["n"]:
                    todo.append((place, rest, r["low"], r["high"]))
                    break
                rest -= r["n"]
        return found

    n = over.count()
    if not n:
        return spark.createDataFrame([(None, None, 0)], "p50 double, p95 double, n long")
    places = [(n - 1) // 2, n // 2, math.floor(n * 0.95)]
    value = at(sorted({*places[:2], min(places[2], n - 1)}))
    return spark.createDataFrame([((value[places[0]] + value[places[1]]) / 2, value[min(places[2], n - 1)], n)], "p50 double, p95 double, n long")


def compare_runs(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """(metric, base, tuned, diff to 4 digits, change) for metrics (metric, value) that both runs
    have; the change is judged by the exact difference."""
    a, b = base.select("metric", F.col("value").alias("base")), tuned.select("metric", F.col("value").alias("tuned"))
    diff = F.col("tuned") - F.col("base")
    return a.join(b, "metric").select("metric", "base", "tuned", F.round(diff, 4).alias("diff"), F.when(F.abs(diff) < 0.001, "unchanged").when(diff > 0, "improvement").otherwise("regression").alias("change"))


def schema_validity(df: DataFrame, column: str) -> DataFrame:
    """Shares of texts that are JSON, and that are structured answers; 0 without rows."""
    checked = df.select(tx.strict_json(F.col(column)).alias("j"))
    rate = lambda c: F.coalesce(F.avg(c.cast("double")), F.lit(0.0))
    return checked.agg(rate(F.col("j").isNotNull()).alias("json_rate"), rate(F.coalesce(tx.is_valid_output(F.col("j")), F.lit(False))).alias("schema_rate"))


def answer_metrics(df: DataFrame, pred: str, gold: str, second: str) -> DataFrame:
    """Accuracy without regard to case, where a second label counts too, and the share of rows with a prediction."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    hit = F.col(pred).isNotNull() & ((low(pred) == low(gold)) | ((low(second) != "") & (low(pred) == low(second))))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"), F.avg(F.col(pred).isNotNull().cast("double")).alias("parsed"), F.count(F.lit(1)).alias("n"))


def join_gold(results: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """Results with the gold columns of their key; nulls where there is no gold row."""
    return results.join(gold, key, "left")


def right_label(pred: Column, gold: Column, second: Column) -> Column:
    """Whether a predicted label is the gold one or the second one, without regard to case; false for null."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return pred.isNotNull() & ((low(pred) == low(gold)) | ((low(second) != "") & (low(pred) == low(second))))


def projected_accuracy(results: DataFrame, gold: DataFrame, key: str, pred: str, label: str, second: str) -> DataFrame:
    """One row: correct, total and accuracy (0 without rows) of results against gold labels, say
    after apply_fixes, where a second label counts too."""
    joined = join_gold(results.select(key, F.col(pred).alias("pred__")), gold.select(key, F.col(label).alias("gold__"), F.col(second).alias("second__")), key)
    hit = right_label(F.col("pred__"), F.col("gold__"), F.col("second__"))
    n = F.count(F.lit(1))
    return joined.agg(F.count_if(hit).alias("correct"), n.alias("total"), F.when(n > 0, F.count_if(hit) / n).otherwise(0.0).alias("accuracy"))


def ticket_metrics(df: DataFrame, answer: str, gold: Mapping[str, str], latency: str) -> DataFrame:
    """One row on structured answers (a struct column, null where none was read) against gold columns
    (``gold``: intent, second, urgency, workflow_steps and tools_required to column names).

    Intent and urgency without regard to case, over all rows; the agreement of steps (Jaccard) and
    tools (F1), as sets of stripped lower-case items, over read rows with gold items only.
    """
    there = F.col(answer).isNotNull()
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    clean = lambda c: F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda t: F.lower(tx.strip(t))))

    def both(df: DataFrame, n: str) -> DataFrame:
        return df.withColumns({f"p_{n}": clean(F.col(f"{answer}.{n}")), f"g_{n}": clean(F.col(gold[n])), f"on_{n}": there & (F.size(gold[n]) > 0)})

    rows = both(both(df, "workflow_steps"), "tools_required")
    steps = tx.jaccard(F.col("p_workflow_steps"), F.col("g_workflow_steps"))
    tools = tx.set_f1(F.col("p_tools_required"), F.col("g_tools_required"))
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    rate = lambda c: mean(F.coalesce(c, F.lit(False)).cast("double"))
    return rows.agg(
        rate(there & right_label(F.coalesce(F.col(f"{answer}.intent"), F.lit("")), F.col(gold["intent"]), F.col(gold["second"]))).alias("intent_accuracy"),
        rate(there & (low(F.col(f"{answer}.urgency")) == low(F.col(gold["urgency"])))).alias("urgency_accuracy"),
        mean(F.when(F.col("on_workflow_steps"), steps)).alias("workflow_accuracy"),
        mean(F.when(F.col("on_tools_required"), tools)).alias("tool_f1"),
        rate(there).alias("json_parse_rate"),
        mean(F.col(latency)).alias("mean_latency"),
        F.count(F.lit(1)).alias("total"),
        F.count_if("on_workflow_steps").alias("workflow_evaluated"),
        F.count_if("on_tools_required").alias("tools_evaluated"),
    )


# ---------------------------------------------------------------- suites

ANSWER = "struct<intent:string,urgency:string,workflow_steps:array<string>,tools_required:array<string>,reasoning:string,response:string>"


def read_answers(df: DataFrame, raw: str, out: str = "answer") -> DataFrame:
    """Adds the structured answer of a raw text, null where it has not all six fields."""
    parsed = df.withColumn("parsed__", tx.strict_json(F.col(raw)))
    return parsed.withColumn(out, F.when(tx.is_valid_output(F.col("parsed__")), F.try_variant_get("parsed__", "$", ANSWER))).drop("parsed__")


def _eligible(df: DataFrame, *required: str) -> DataFrame:
    return df.dropna(subset=list(required)) if set(required) <= set(df.columns) else df.limit(0)


def _long(one: DataFrame) -> DataFrame:
    """(metric, value) of a row of metrics."""
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one.columns])).alias("m")).select("m.metric", "m.value")


def intent_suite(df: DataFrame, raw: str) -> DataFrame:
    """Metrics of rows with customer_message and intent: micro and macro F1 and accuracy of the
    intents, and of the urgencies where there are any; an answer that can't be read is unknown and medium."""
    rows = read_answers(_eligible(df, "customer_message", "intent"), raw)
    rows = rows.withColumns({"p__": F.coalesce("answer.intent", F.lit("unknown")), "u__": F.coalesce("answer.urgency", F.lit("medium"))})
    f1 = f1_summary(rows, "p__", "intent").select(F.round("micro_f1", 4).alias("micro_f1"), F.round("macro_f1", 4).alias("macro_f1"))
    out = f1.crossJoin(decision_accuracy(rows, "p__", "intent").withColumnRenamed("accuracy", "intent_accuracy")).crossJoin(rows.agg(F.count(F.lit(1)).alias("num_examples")))
    if "urgency" in df.columns:
        out = out.crossJoin(decision_accuracy(rows.where("urgency IS NOT NULL"), "u__", "urgency").withColumnRenamed("accuracy", "urgency_accuracy"))
    return _long(out)


def _listed(df: DataFrame, column: str) -> Column:
    """A list column, or a text as the only item of one."""
    return F.col(column) if df.schema[column].dataType.typeName() == "array" else F.array(column)


def tool_suite(df: DataFrame, raw: str) -> DataFrame:
    """Metrics of rows with customer_message and tools_required: micro scores of the tool sets and the number of rows that differ."""
    rows = _eligible(df, "customer_message", "tools_required")
    rows = read_answers(rows.withColumn("g__", _listed(rows, "tools_required")), raw).withColumn("p__", F.coalesce("answer.tools_required", F.array().cast("array<string>")))
    differ = (F.size(F.array_except("g__", "p__")) > 0) | (F.size(F.array_except("p__", "g__")) > 0)
    scores = tool_set_scores(rows, "p__", "g__").select(F.col("f1").alias("tool_f1"), F.col("precision").alias("tool_precision"), F.col("recall").alias("tool_recall"))
    return _long(scores.crossJoin(rows.agg(F.count(F.lit(1)).alias("num_examples"), F.count_if(differ).alias("num_errors"))))


def workflow_suite(df: DataFrame, raw: str) -> DataFrame:
    """Metrics of rows with customer_message and workflow_steps: the mean agreement by edit distance."""
    rows = _eligible(df, "customer_message", "workflow_steps")
    rows = read_answers(rows.withColumn("g__", _listed(rows, "workflow_steps")), raw).withColumn("p__", F.coalesce("answer.workflow_steps", F.array().cast("array<string>")))
    return _long(workflow_accuracy(rows, "p__", "g__").select(F.col("mean_accuracy").alias("workflow_accuracy")).crossJoin(rows.agg(F.count(F.lit(1)).alias("num_examples"))))


def safety_suite(df: DataFrame, raw: str) -> DataFrame:
    """Metrics of rows with customer_message: the rates of unsafe answers, to 4 digits (0 without rows)."""
    from corpusmill.operators.score import safety_summary

    one = safety_summary(_eligible(df, "customer_message"), raw)
    rates = [F.round(F.coalesce(c, F.lit(0.0)), 4).alias(c) for c in ("pii_leak_rate", "policy_violation_rate", "scope_breach_rate")]
    return _long(one.select(*rates, F.coalesce("total_violations", F.lit(0)).alias("total_violations"), "num_examples"))


SUITES: dict[str, Callable[[DataFrame, str], DataFrame]] = {"intent": intent_suite, "tool_calling": tool_suite, "workflow": workflow_suite, "safety": safety_suite}


def run_suite(df: DataFrame, raw: str, name: str) -> DataFrame:
    if name not in SUITES:
        raise ValueError(f"unknown suite {name!r}; known: {', '.join(SUITES)}")
    return SUITES[name](df, raw)


def run_suites(df: DataFrame, raw: str, names: Sequence[str] = tuple(SUITES)) -> DataFrame:
    """(suite, metric, value, error) of the suites in turn; a suite that fails gives one row with its
    error, and the others go on.  Each suite is a handful of numbers and is run here."""
    rows = []
    for name in names:
        try:
            rows += [(name, r["metric"], r["value"], None) for r in run_suite(df, raw, name).collect()]
        except Exception as e:  # a failing suite is a result
            rows.append((name, None, None, str(e).splitlines()[0]))
    return df.sparkSession.createDataFrame(rows, "suite string, metric string, value double, error string")


def significance(df: DataFrame, variant: str, value: str, first: str, second: str) -> DataFrame:
    """The equal-variance t-test of two variants: one row with t, p and the winner by mean (p < .05),
    null with fewer than five values in either."""
    stats = df.where(F.col(variant).isin(first, second)).groupBy(variant).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"))
    by = {r[variant]: r.asDict() for r in stats.collect()}
    got = t_statistic(by[first], by[second]) if first in by and second in by else None
    winner = None if got is None or got[1] >= 0.05 else first if by[first]["mean"] > by[second]["mean"] else second
    return df.sparkSession.createDataFrame([(got and got[0], got and got[1], winner)], "t double, p double, winner string")


def against_targets(metrics: DataFrame, targets: Mapping[str, float]) -> DataFrame:
    table = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
    goal = F.element_at(table, F.col("metric"))
    return metrics.where(goal.isNotNull()).select("metric", "value", goal.alias("target"), (F.col("value") >= goal).alias("met"))


def likely_class(text: Column, signals: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]]) -> Column:
    """The class with most keywords found, two off for each contrary one; null if none is over 0.

    Ties go to the class listed first.
    """
    low, scores = F.lower(text), []
    for i, (name, (yes, no)) in enumerate(signals.items()):
        s = tx.count_in(low, [w.lower() for w in yes]) - 2 * tx.count_in(low, [w.lower() for w in no])
        scores.append(F.when(s > 0, F.struct(s.alias("s"), F.lit(-i).alias("i"), F.lit(name).alias("c"))))
    return F.array_max(F.array(*scores))["c"]


def audit_labels(df: DataFrame, pred: str, gold: str, hint: str) -> DataFrame:
    """Wrong predictions with an action: relabel if the hint agrees with the prediction,
    add_secondary without a hint, else keep_gold."""
    wrong = df.where(F.col(pred) != F.col(gold))
    return wrong.withColumn("action", F.when(F.col(hint) == F.col(pred), "relabel").when(F.col(hint).isNull(), "add_secondary").otherwise("keep_gold"))


def apply_fixes(gold: DataFrame, fixes: DataFrame, key: str, label: str, secondary: str) -> DataFrame:
    """Gold rows after relabelling; a second label only where there is none."""
    changes = fixes.select(F.col(key).alias("k__"), F.col("action").alias("a__"), F.col("new_label").alias("l__"))
    out = gold.join(changes, F.col(key) == F.col("k__"), "left")
    out = out.withColumn(secondary, F.when((F.col("a__") == "add_secondary") & (F.coalesce(secondary, F.lit("")) == ""), F.col("l__")).otherwise(F.col(secondary)))
    return out.withColumn(label, F.when(F.col("a__") == "relabel", F.col("l__")).otherwise(F.col(label))).drop("k__", "a__", "l__")


# ---------------------------------------------------------------- preference pairs


def best_and_worst(df: DataFrame, group: str, order: str, response: str, score: str, margin: float = 0.5) -> DataFrame:
    """(group, chosen, rejected): the best (first) and worst (first) response of each prompt, where
    there are two and their scores differ by ``margin``."""
    best = F.max_by(response, F.struct(F.col(score), -F.col(order))).alias("chosen")
    worst = F.min_by(response, F.struct(F.col(score), F.col(order))).alias("rejected")
    found = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max(score).alias("high"), F.min(score).alias("low"), best, worst)
    return found.where((F.col("n") >= 2) & (F.col("high") > F.col("low")) & (F.col("high") - F.col("low") >= margin)).select(group, "chosen", "rejected")


def by_score(score: Column, high: float = 4, low: float = 2) -> Column:
    """chosen, rejected, or null between."""
    return F.when(score >= high, "chosen").when(score <= low, "rejected")


def correction_pair(before: Column, after: Column) -> Column:
    return F.when(before != after, F.struct(after.alias("chosen"), before.alias("rejected")))


# ---------------------------------------------------------------- experiments


def assign_variant(experiment: str | None, user: Column, shares: Mapping[str, float]) -> Column:
    """The variant whose cumulated share, in order, holds the user's md5 bucket of 100."""
    if abs(sum(shares.values()) - 1) > 0.01:
        raise ValueError("the shares must add up to 1")
    text = user.cast("string") if experiment is None else F.concat(F.lit(f"{experiment}:"), user.cast("string"))
    bucket, upto, out = tx.bucket100(text), 0.0, None
    names = list(shares)
    for name in names[:-1]:
        upto += shares[name] * 100
        out = F.when(bucket < upto, name) if out is None else out.when(bucket < upto, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


class Experiments:
    """Experiments by name, each with its variants and their shares of the users."""

    def __init__(self):
        self._shares: dict[str, dict[str, float]] = {}

    def create(self, name: str, variants: Sequence[str], shares: Mapping[str, float]) -> None:
        if abs(sum(shares.values()) - 1) > 0.01:
            raise ValueError("the shares must add up to 1")
        if missing := [v for v in variants if v not in shares]:
            raise ValueError(f"no share for {', '.join(missing)}")
        self._shares[name] = dict(shares)

    def assign(self, name: str, user: Column) -> Column:
        return assign_variant(name, user, self._shares[name])


class Router:
    """The adapter that serves each stage, or by user the variants of a running experiment."""

    def __init__(self, adapters: Mapping[str, str], default: str = "response-gen"):
        self._adapters, self._default = dict(adapters), default
        self._experiments: dict[str, tuple[dict[str, str], dict[str, float]]] = {}

    def register(self, stage: str, variants: Mapping[str, str], shares: Mapping[str, float]) -> None:
        if abs(sum(shares.values()) - 1) > 0.01:
            raise ValueError("the shares must add up to 1")
        self._experiments[stage] = dict(variants), dict(shares)

    def route(self, stage: Column, user: Column | None = None) -> Column:
        """The adapter of a stage: that of the user's variant where the stage has an experiment and
        there is a user (the bucket is that of the user alone), else the stage's own, else the default."""
        plain = tx.lookup(self._adapters, stage, self._adapters.get("response", self._default))
        out = F
        for name, (variants, shares) in self._experiments.items() if user is not None else ():
            chosen = tx.lookup(variants, assign_variant(None, user, shares), self._adapters.get(name, self._default))
            out = out.when((stage == name) & (F.coalesce(user.cast("string"), F.lit("")) != ""), chosen)
        return plain if out is F else out.otherwise(plain)


def record_metrics(df: DataFrame, path: str) -> None:
    """Appends (experiment, variant, metric, value) rows to the table of results."""
    df.select("experiment", "variant", "metric", F.col("value").cast("double").alias("value")).write.mode("append").parquet(path)


def experiment_results(df: DataFrame) -> DataFrame:
    """(experiment, variant, metric, count, mean, min, max), to 4 digits, of recorded rows."""
    rounded = lambda c, n: F.round(c, 4).alias(n)
    return df.groupBy("experiment", "variant", "metric").agg(F.count("value").alias("count"), rounded(F.avg("value"), "mean"), rounded(F.min("value"), "min"), rounded(F.max("value"), "max"))


def variant_summary(df: DataFrame, variant: str, metric: str, value: str) -> DataFrame:
    return df.groupBy(variant, metric).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"), F.var_samp(value).alias("variance"))


def t_statistic(a: Mapping, b: Mapping) -> tuple[float, float] | None:
    """(t, two-sided p) of the equal-variance t-test of two summaries; null under five values each."""
    n, m = a["n"], b["n"]
    if n < 5 or m < 5:
        return None
    pooled = ((n - 1) * a["variance"] + (m - 1) * b["variance"]) / (n + m - 2)
    if pooled == 0:
        return (0.0, 1.0) if a["mean"] == b["mean"] else (math.inf, 0.0)
    t = (a["mean"] - b["mean"]) / math.sqrt(pooled * (1 / n + 1 / m))
    df = n + m - 2
    return t, incomplete_beta(df / 2, 0.5, df / (df + t * t))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    tiny, c = 1e-300, 1.0
    d = 1 / max(tiny, 1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 400):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + k * d) or tiny)
            c = (1 + k / c) or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h
