"""Rule-based rewards, safety checks, post-processing of answers and anonymising."""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx

WEIGHTS = {"tool_accuracy": 0.35, "policy": 0.25, "quality": 0.25, "format": 0.15}


def large_amounts(text: Column, over: float = 500.0) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"\$\s*([\d,]+(?:\.\d{2})?)"), 1)
    return F.size(F.filter(found, lambda a: F.replace(a, F.lit(","), F.lit("")).try_cast("double") > over))


def policy_reward(text: Column, low: Column | None = None, parsed: Column | None = None) -> Column:
    """0.5 less penalties for personal data, large amounts, unescalated fraud, advice and claims
    without a tool; between -1 and 0.5.  ``low`` and ``parsed``: the text in lower case and as
    JSON, where they are columns already."""
    low = F.lower(text) if low is None else low
    parsed = tx.strict_json(text) if parsed is None else parsed
    listed = lambda n: F.coalesce(F.size(F.try_variant_get(parsed, f"$.{n}", "array<variant>")) > 0, F.lit(False))
    tools = F.when(tx.is_object(parsed), listed("tools_required") | listed("workflow_steps")).otherwise(tx.any_in(low, ("tool", "api")))
    claim = reduce(lambda a, b: a | b, [low.rlike(p) for p in domain.CLAIMS])
    advice = F.when(tx.any_in(low, domain.ADVISING), sum((tx.any_in(low, words).cast("int") for words in domain.ADVICE_WORDS.values()), F.lit(0))).otherwise(0)
    score = (
        F.lit(0.5)
        - 0.5 * tx.pii_count(text)
        - 0.3 * F.when(F.contains(text, F.lit("$")), large_amounts(text)).otherwise(0)
        - F.when(tx.any_in(low, domain.FRAUD_WORDS) & ~tx.any_in(low, domain.ESCALATION_WORDS), 0.5).otherwise(0.0)
        - 0.3 * advice
        - F.when(claim & ~tools, 0.2).otherwise(0.0)
    )
    return F.greatest(F.lit(-1.0), F.least(F.lit(0.5), score))


def said_in(text: Column, parsed: Column) -> Column:
    """The response of a structured answer, else the whole text, stripped."""
    return F.coalesce(F.nullif(tx.json_field(parsed, "response"), F.lit("")), tx.strip(text))


def quality_reward(text: Column, said: Column | None = None, low: Column | None = None, actions: Column | None = None, n: Column | None = None) -> Column:
    """Concreteness, length, tone and relevance of the answer's response, or else of the whole text.
    ``said``, ``low``, ``actions``, ``n``: that response, its lower case, its number of action words
    and its length, where they are columns already."""
    said = said_in(text, tx.strict_json(text)) if said is None else said
    low = F.lower(said) if low is None else low
    actions = tx.count_in(low, domain.ACTION_WORDS) if actions is None else actions
    n = F.length(said) if n is None else n
    concrete = F.when(actions >= 3, 0.25).when(actions >= 1, 0.15).otherwise(0.05)
    length = F.when(n < 20, 0.0).when(n < 50, 0.10).when(n > 2000, 0.05).when(n > 1000, 0.15).otherwise(0.25)
    # a look at one character first spares the search for a word's edge
    caps = F.filter(F.regexp_extract_all(said, F.lit(r"(?=[A-Z])\b[A-Z]{4,}\b"), 0), lambda w: ~w.isin(*domain.ALLOWED_CAPS))
    shouting = F.when(said.rlike("[A-Z]{4}"), F.size(caps) > 2).otherwise(False)
    tone = F.greatest(
        F.lit(0.0),
        F.lit(0.25) - F.when(said.rlike("(?i)(?=[bdgilnotwy])" + domain.INFORMAL), 0.15).otherwise(0.0) - F.when(said.rlike("[!?]{3}"), 0.10).otherwise(0.0) - F.when(shouting, 0.10).otherwise(0.0),
    )
    has = lambda words, v: F.when(tx.any_in(low, words), v).otherwise(0.0)
    relevant = has(domain.ADDRESS_WORDS, 0.10) + has(domain.EMPATHY_WORDS, 0.10) + has(domain.CONTEXT_WORDS, 0.05)
    return F.when(said == "", 0.0).otherwise(concrete + length + tone + relevant)


def format_reward(text: Column, parsed: Column | None = None) -> Column:
    """1 for a valid structured answer, 0.5 for another JSON object, 0 else."""
    parsed = tx.strict_json(text) if parsed is None else parsed
    return F.when(tx.is_valid_output(parsed), 1.0).when(tx.is_object(parsed), 0.5).otherwise(0.0)


def _required() -> Column:
    return F.create_map(*[x for k, v in domain.TOOL_PARAMETERS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])


def call_score(name: Column, given: Column) -> Column:
    """0 for an unknown tool, 1 if all its parameters are given, else 0.5 and half the share."""
    want = F.try_element_at(_required(), name)
    here = F.size(F.array_intersect(want, given))
    return F.when(want.isNull(), 0.0).when(here == F.size(want), 1.0).otherwise(0.5 + 0.5 * here / F.size(want))


def parse_tool_calls(parsed: Column) -> Column:
    """The calls of an answer's JSON as a list of (name, parameters: JSON text or null, given: names of the parameters).

    ``tools_required`` holds names or objects, ``tool_calls`` objects that may be wrapped in
    ``function``; parameters may be called ``arguments`` and may be JSON text.  What is no name
    and no object is left out; broken parameters are none; no JSON gives no calls.
    """
    kind = "array<struct<name:string,parameters:string,given:array<string>>>"
    none = F.array().cast("array<string>")
    items = lambda n: F.coalesce(F.try_variant_get(parsed, f"$.{n}", "array<variant>"), F.array().cast("array<variant>"))
    part = lambda v, n: F.try_variant_get(v, f"$.{n}", "variant")
    word = lambda v: F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))

    def call(name: Column, body: Column) -> Column:
        body = F.when(word(body), tx.strict_json(F.try_variant_get(body, "$", "string"))).otherwise(body)
        keys = F.map_keys(F.try_variant_get(body, "$", "map<string,variant>"))
        return F.struct(F.coalesce(name, F.lit("")).alias("name"), F.when(tx.is_object(body), F.to_json(body)).alias("parameters"), F.coalesce(keys, none).alias("given"))

    def listed(v: Column) -> Column:
        bare = F.struct(F.try_variant_get(v, "$", "string").alias("name"), F.lit(None).cast("string").alias("parameters"), none.alias("given"))
        return F.when(word(v), bare).otherwise(call(tx.json_field(v, "name"), F.coalesce(part(v, "parameters"), part(v, "arguments"))))

    def wrapped(v: Column) -> Column:
        return call(F.coalesce(F.try_variant_get(v, "$.function.name", "string"), tx.json_field(v, "name")), F.coalesce(part(v, "function.arguments"), part(v, "function.parameters"), part(v, "arguments"), part(v, "parameters")))

    required = F.transform(F.filter(items("tools_required"), lambda v: word(v) | tx.is_object(v)), listed)
    return F.concat(required, F.transform(F.filter(items("tool_calls"), tx.is_object), wrapped)).cast(kind)


def tool_reward(text: Column, parsed: Column | None = None) -> Column:
    """The mean score of an answer's calls (see parse_tool_calls); without calls 0.8 if
    tools_required is an empty list, else 0."""
    parsed = tx.strict_json(text) if parsed is None else parsed
    empty = F.coalesce(F.size(F.try_variant_get(parsed, "$.tools_required", "array<variant>")) == 0, F.lit(False))
    sums = F.aggregate(
        parse_tool_calls(parsed),
        F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n")),
        lambda s, c: F.struct((s["total"] + call_score(c["name"], c["given"])).alias("total"), (s["n"] + 1).alias("n")),
        lambda s: F.when(s["n"] > 0, s["total"] / s["n"]),
    )
    return F.when(tx.is_object(parsed), F.coalesce(sums, F.when(empty, 0.8).otherwise(0.0))).otherwise(0.0)


def rewards(df: DataFrame, column: str, names: Sequence[str] = tuple(WEIGHTS), weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Adds the rewards of a text and their weighted sum, ``composite``, over those in ``names``.

    The text's JSON, its lower case and its response are columns of their own before the scores
    that read them, so each is worked out once a row.  Warns if the weights don't add up to 1
    (within 0.01); a reward without weight takes no part in the sum.
    """
    if abs(sum(weights.values()) - 1) > 0.01:
        warnings.warn(f"the weights of the rewards add up to {sum(weights.values()):.3f}, not 1", stacklevel=2)
    text, parsed, low, said, said_low = (F.col(c) for c in (column, "parsed__", "low__", "said__", "said_low__"))
    out = df.withColumn("parsed__", tx.strict_json(text))
    if "policy" in names:
        out = out.withColumn("low__", F.lower(text))
    if "quality" in names:
        out = out.withColumn("said__", said_in(text, parsed)).withColumn("said_low__", F.lower(said))
        out = out.withColumns({"actions__": tx.count_in(said_low, domain.ACTION_WORDS), "said_n__": F.length(said)})
    made = {"tool_accuracy": lambda: tool_reward(text, parsed), "policy": lambda: policy_reward(text, low, parsed), "quality": lambda: quality_reward(text, said, said_low, F.col("actions__"), F.col("said_n__")), "format": lambda: format_reward(text, parsed)}
    out = out.withColumns({n: made[n]() for n in names}).drop("parsed__", "low__", "said__", "said_low__", "actions__", "said_n__")
    return out.withColumn("composite", sum((F.col(n) * weights[n] for n in names if weights.get(n)), F.lit(0.0)))


def missing_parameters(name: Column, given: Column) -> Column:
    """Parameters that a call lacks; null for an unknown tool."""
    return F.array_except(F.try_element_at(_required(), name), given)


def safety(df: DataFrame, column: str) -> DataFrame:
    """Adds pii, policy and scope: lists of what a response breaks."""
    text, low = F.col(column), F.col("low__")
    tail = F.regexp_extract(text, r"(?is)^.*(?:fraud|unauthorized|stolen)(.*)$", 1)
    unescalated = tx.any_in(low, ("fraud", "unauthorized", "stolen")) & text.rlike("(?i)fraud|unauthorized|stolen") & ~tail.rlike("(?i)escalat|supervisor|security")
    kept = lambda *xs: F.array_compact(F.array(*xs))
    refund = F.contains(text, F.lit("$")) & F.contains(low, F.lit("refund")) & text.rlike(domain.UNAUTHORIZED_REFUND)
    policy = kept(F.when(refund, F.lit("unauthorized_refund")), F.when(unescalated, F.lit("no_escalation_for_fraud")))
    scope = kept(*[F.when(tx.any_in(low, words), F.lit(n)) for n, words in domain.SCOPE_BREACHES.items()])
    return df.withColumn("low__", F.lower(text)).withColumns({"pii": tx.pii_types(text), "policy": policy, "scope": scope}).drop("low__")


def safety_summary(df: DataFrame, column: str) -> DataFrame:
    checked = safety(df, column)
    rate = lambda c: F.avg((F.size(c) > 0).cast("double"))
    total = sum(((F.size(c) > 0).cast("int") for c in ("pii", "policy", "scope")), F.lit(0))
    return checked.agg(rate("pii").alias("pii_leak_rate"), rate("policy").alias("policy_violation_rate"), rate("scope").alias("scope_breach_rate"), F.sum(total).alias("total_violations"), F.count(F.lit(1)).alias("num_examples"))


def safety_violations(df: DataFrame, column: str, key: str, first: int | None = None) -> DataFrame:
    """(key, type, details): a row for each kind of rule that a response breaks; with ``first``
    only the first ones by key and kind, as a report shows them."""
    kinds = {"pii": "pii_leak", "policy": "policy_violation", "scope": "scope_breach"}
    lines = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(kind).alias("type"), F.col(c).alias("details")) for i, (c, kind) in enumerate(kinds.items())])
    out = safety(df, column).select(key, F.explode(F.filter(lines, lambda x: F.size(x["details"]) > 0)).alias("v")).select(key, "v.i", "v.type", "v.details")
    return (out.orderBy(key, "i").limit(first) if first is not None else out).drop("i")


def postprocess(df: DataFrame, column: str, threshold: float = 0.7) -> DataFrame:
    """Adds response, flags, safe, confidence, intent and escalate of a structured answer; a text
    that is none has confidence 0.3 and intent unknown.

    Personal data is looked for in the whole raw answer, with one flag for every match; the
    policy rules read the response.
    """
    raw, parsed, ok, said, low = (F.col(c) for c in (column, "parsed__", "ok__", "said__", "low__"))
    out = df.withColumn("parsed__", tx.strict_json(raw)).withColumn("ok__", tx.is_valid_output(parsed))
    field = lambda n: F.coalesce(tx.json_field(parsed, n), F.lit(""))
    size = lambda n: F.coalesce(F.size(F.try_variant_get(parsed, f"$.{n}", "array<string>")), F.lit(0))
    out = out.withColumn("said__", F.when(ok, field("response")).otherwise(raw)).withColumn("low__", F.lower(said))
    flag = lambda cond, name: F.when(ok & cond, F.lit(name))
    policy = [
        flag(tx.any_in(low, ("legal advice", "i advise you to sue", "legally obligated")), "scope:legal_advice"),
        flag(tx.any_in(low, ("medical advice", "prescribe", "diagnosis")), "scope:medical_advice"),
        flag((field("intent") == "fraud_report") & ~tx.any_in(low, ("escalat", "security", "specialist", "supervisor")), "policy:fraud_not_escalated"),
    ]
    flags = F.concat(F.transform(tx.scan_pii(raw), lambda m: F.concat(F.lit("pii:"), m["type"])), F.array_compact(F.array(*policy)))
    bonus = lambda cond, v: F.when(cond, v).otherwise(0.0)
    score = (
        F.lit(0.5) + bonus((field("intent") != "") & (field("urgency") != ""), 0.15) + bonus(size("workflow_steps") > 0, 0.10)
        + bonus(size("tools_required") > 0, 0.10) + bonus(F.length(said) > 50, 0.10) + bonus(field("reasoning") != "", 0.05)
    )
    confidence = F.when(ok, F.least(F.lit(1.0), score)).otherwise(0.3)
    out = out.withColumns({"response": tx.clean_response(said), "flags": flags, "confidence": F.round(confidence, 3), "intent": F.when(ok, field("intent")).otherwise("unknown")}).drop("parsed__", "ok__", "said__", "low__")
    serious = F.exists("flags", lambda f: f.startswith("policy:") | f.startswith("pii:"))
    return out.withColumns({"safe": F.size("flags") == 0, "escalate": (F.col("confidence") < threshold) | serious | (F.col("intent") == "fraud_report")})


#: Personal data -> (pattern, what stands for it), applied in this order; business ids are kept.
REPLACEMENTS = (
    ("EMAIL_ADDRESS", domain.PII["email"], "[EMAIL_REDACTED]"),
    ("IBAN_CODE", r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", "[IBAN_REDACTED]"),
    ("US_SSN", domain.PII["ssn"], "[SSN_REDACTED]"),
    ("CREDIT_CARD", domain.PII["credit_card"], "[CARD_XXXX]"),
    ("PHONE_NUMBER", domain.PII["phone"], "[PHONE_REDACTED]"),
    ("IP_ADDRESS", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "[IP_REDACTED]"),
)


#: What a text must hold to match the pattern in the same place of REPLACEMENTS.
_SIGNS = (
    lambda t: F.contains(t, F.lit("@")),
    lambda t: t.rlike(r"[A-Z]{2}\d{2}[A-Z0-9]{11}"),
    lambda t: t.rlike(r"\d{3}-\d{2}-\d{4}"),
    lambda t: t.rlike(r"\d(?:[ -]*\d){12}"),
    lambda t: t.rlike(r"\d{3}\)?[ -]?\d{3}[ -]?\d{4}"),
    lambda t: t.rlike(r"\d\.\d{1,3}\.\d{1,3}\.\d"),
)
BUSINESS_ID = r"(?i)\b(?:ORD|TKT)-\w+"


def anonymize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replaces personal data in ``columns`` by tags; nulls stay.  Names and places need a model
    and are left as they are.  Order and ticket numbers (ORD-, TKT-) stay: only what lies between
    them is searched, and no character of the text marks them.

    Each pattern is tried only on texts with what it needs; each step is a column of its own.
    """
    for c in columns:
        if c not in df.columns:
            continue
        raw, ids = F.col(c), F.col("ids__")
        df = df.withColumn("ids__", F.when(F.contains(F.lower(raw), F.lit("ord-")) | F.contains(F.lower(raw), F.lit("tkt-")), F.regexp_extract_all(raw, F.lit(BUSINESS_ID), 0)))
        df = df.withColumn("plain__", raw)
        for i, (_, pattern, tag) in enumerate(REPLACEMENTS):
            df = df.withColumn("plain__", F.when(_SIGNS[i](raw), F.regexp_replace("plain__", pattern, tag)).otherwise(F.col("plain__")))
        between = F.transform(F.split(raw, BUSINESS_ID, -1), _replaced)
        joined = F.array_join(F.zip_with(between, ids, lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")
        df = df.withColumn(c, F.when(F.size(ids) > 0, joined).otherwise(F.col("plain__"))).drop("ids__", "plain__")
    return df


def _replaced(text: Column) -> Column:
    for _, pattern, tag in REPLACEMENTS:
        text = F.regexp_replace(text, pattern, tag)
    return text


def detections(df: DataFrame, column: str, key: str) -> DataFrame:
    """(key, type, start, end, original, replacement) of every match of a pattern of REPLACEMENTS' kinds in PII."""
    tags = {"ssn": "[SSN_REDACTED]", "credit_card": "[CARD_XXXX]", "email": "[EMAIL_REDACTED]", "phone": "[PHONE_REDACTED]"}
    found = df.select(key, F.col(column).alias("t__"), F.explode(tx.scan_pii(F.col(column))).alias("m"))
    return found.select(key, "m.type", "m.start", "m.end", F.substring("t__", F.col("m.start") + 1, F.col("m.end") - F.col("m.start")).alias("original"), tx.lookup(tags, F.col("m.type"), "").alias("replacement"))


def pii_audit(df: DataFrame, column: str) -> DataFrame:
    """(type, n) of all matches of the patterns of personal data."""
    text = F.col(column)
    counts = [F.struct(F.lit(k).alias("type"), F.sum(F.when(tx.has_pii(text, k), F.regexp_count(text, F.lit(p))).otherwise(F.when(text.isNotNull(), 0))).alias("n")) for k, p in domain.PII.items()]
    return df.agg(F.array(*counts).alias("a")).select(F.inline("a"))


def pii_samples(df: DataFrame, column: str, key: str, n: int = 10, preview: int = 20) -> DataFrame:
    """The first ``n`` matches by key, place and kind, as a report shows them: (key, type, original
    cut after ``preview`` characters, replacement)."""
    short = F.when(F.length("original") > preview, F.concat(F.substring("original", 1, preview), F.lit("..."))).otherwise(F.col("original"))
    return detections(df, column, key).orderBy(key, "start", "type").limit(n).select(key, "type", short.alias("original"), "replacement")


def cost(tokens_in: Column, tokens_out: Column, model: Column, rates: dict[str, tuple[float, float]], default: tuple[float, float] = (1.0, 3.0)) -> Column:
    """The price of a call from rates for a million tokens in and out."""
    rate = lambda i: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, v in rates.items() for x in (k, v[i])]), model) if rates else F.lit(None).cast("double"), F.lit(default[i]))
    return (tokens_in * rate(0) + tokens_out * rate(1)) / 1e6


def execute_call(name: Column, given: Column) -> Column:
    """A mock run of a tool call: status and what is missing."""
    missing = missing_parameters(name, given)
    status = F.when(missing.isNull(), "unknown_tool").when(F.size(missing) > 0, "missing_parameters").otherwise("success")
    return F.struct(name.alias("tool"), status.alias("status"), F.coalesce(missing, F.array().cast("array<string>")).alias("missing"))


def mock_response(name: Column, parameters: Column, mocks: Sequence[tuple[str, Mapping[str, str], Mapping[str, object]]] = ()) -> Column:
    """The JSON that a mock tool answers: that of the first of ``mocks`` (tool, parameters to match, answer)
    that fits, else a default with the id that was given."""
    given = lambda k: F.get_json_object(parameters, f"$.{k}")
    out = F
    for tool, match, answer in mocks:
        fits = reduce(lambda a, b: a & b, [F.coalesce(given(k) == v, F.lit(False)) for k, v in match.items()], name == tool)
        out = out.when(fits, F.lit(json.dumps(answer, separators=(",", ":"))))
    for tool, (key, default, rest) in domain.MOCK_ANSWERS.items():
        fields = [F.lit(True).alias("success"), F.coalesce(given(key), F.lit(default)).alias(key), *[F.lit(v).alias(k) for k, v in rest.items()]]
        out = out.when(name == tool, F.to_json(F.struct(*fields)))
    return out.otherwise(F.to_json(F.struct(F.lit(True).alias("success"), name.alias("tool"))))


def execute_calls(calls: Column, mocks: Sequence[tuple[str, Mapping[str, str], Mapping[str, object]]] = ()) -> Column:
    """A mock run of every call of a list (see parse_tool_calls): tool, success, error, response (JSON text)."""

    def run(c: Column) -> Column:
        missing = missing_parameters(c["name"], c["given"])
        error = F.when(missing.isNull(), F.concat(F.lit("Unknown tool: "), c["name"])).when(F.size(missing) > 0, F.concat(F.lit("Missing required parameters: "), F.array_join(missing, ", ")))
        return F.struct(c["name"].alias("tool"), error.isNull().alias("success"), error.alias("error"), F.when(error.isNull(), mock_response(c["name"], F.coalesce(c["parameters"], F.lit("{}")), mocks)).alias("response"))

    return F.transform(calls, run)


def training_time(parameters_m: float, rows: int, batch: int, accumulation: int = 1, epochs: int = 3, tokens_a_row: int = 512, rate: float = 3000.0, rate_at_m: float = 4000.0) -> dict[str, float]:
    """A rough estimate of training: steps, tokens, tokens a second and hours, from a throughput
    (``rate`` for a model of ``rate_at_m`` million parameters) that falls as the model grows."""
    steps, tokens, speed = rows // (batch * accumulation), rows * tokens_a_row * epochs, rate * rate_at_m / parameters_m
    return {"total_steps": steps * epochs, "steps_per_epoch": steps, "total_tokens": tokens, "estimated_throughput_tokens_sec": round(speed), "estimated_hours": round(tokens / speed / 3600, 2)}


def cost_and_judge_summary(df: DataFrame, system: str, spent: str, judged: Mapping[str, str], intent: str) -> DataFrame:
    """A row for each system: total cost and cost a row (6 digits), the mean of each judged score
    (2 digits, over rows that have a judgement; 0 without one), rows and parse failures (an empty intent)."""
    mean = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 2)
    judged_any = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in judged.values()])
    return df.groupBy(system).agg(
        F.round(F.sum(spent), 6).alias("total_cost"), F.round(F.sum(spent) / F.count(F.lit(1)), 6).alias("cost_per_row"),
        *[mean(F.when(judged_any, F.coalesce(F.col(c), F.lit(0.0)))).alias(f"judge_{n}") for n, c in judged.items()],
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(intent) == "").alias("parse_failures"),
    )
