"""Column functions over text, lists and JSON text; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill import domain


def bound(value: Column, f) -> Column:
    """``f`` of ``value``, which is evaluated once however often ``f`` refers to it.

    A higher-order function, which leaves code generation: for lists only.  Whole texts get a
    column of their own instead (see ``score.rewards``).
    """
    return F.transform(F.array(value), f)[0]


def any_of(text: Column, words: Iterable[str]) -> Column:
    """Whether lower-cased ``text`` holds any of ``words`` as a substring."""
    return any_in(F.lower(text), words)


def any_in(low: Column, words: Iterable[str]) -> Column:
    """The same for text that is in lower case already."""
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words], F.lit(False))


def count_of(text: Column, words: Iterable[str]) -> Column:
    """How many of ``words`` lower-cased ``text`` holds as substrings."""
    return count_in(F.lower(text), words)


def count_in(low: Column, words: Iterable[str]) -> Column:
    return sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space at both ends (Unicode white space, not just blanks); only texts that
    begin or end with some are searched."""
    edges = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(edges.rlike(r"(?U)\s"), F.regexp_replace(text, r"(?U)^\s+|\s+$", "")).otherwise(text)


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, r"(?U)\s+"), ""))


def non_ascii_share(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x00-\x7F]")) / F.greatest(F.length(text), F.lit(1))


def lookup(mapping: Mapping[str, str], key: Column, default: str) -> Column:
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(table, key), F.lit(default))


#: What a text must hold to match a pattern of personal data; far cheaper to look for than a word edge at every character.
_NEEDED = {
    "ssn": lambda t: t.rlike(r"\d{3}-\d{2}-\d{4}"),
    "credit_card": lambda t: t.rlike(r"\d(?:[ -]*\d){12}"),
    "email": lambda t: F.contains(t, F.lit("@")),
    "phone": lambda t: t.rlike(r"\d{3}\)?[ -]?\d{3}[ -]?\d{4}"),
}


def has_pii(text: Column, kind: str) -> Column:
    """Whether the pattern of this kind of personal data is found in ``text``."""
    return _NEEDED[kind](text) & text.rlike(domain.PII[kind])


def pii_types(text: Column) -> Column:
    """The kinds of personal data that a regular expression finds in ``text``, in a fixed order."""
    return F.array_compact(F.array(*[F.when(has_pii(text, k), F.lit(k)) for k in domain.PII]))


def pii_count(text: Column) -> Column:
    """How many kinds of personal data ``text`` holds."""
    return sum((has_pii(text, k).cast("int") for k in domain.PII), F.lit(0))


def scan_pii(text: Column) -> Column:
    """Every match of every kind: (type, start, end), characters from 0; none for a null text.

    The matches and what lies between them come from the same pattern, so their lengths give the places.
    """
    kind = "array<struct<type:string,start:int,end:int>>"

    def spans(name: str, pattern: str) -> Column:
        found, gaps = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
        step = lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.array_append(s["out"], F.struct(F.lit(name).alias("type"), (s["at"] + F.length(x["gap"])).alias("start"), (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"))).alias("out"),
        )
        pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
        return F.when(has_pii(text, name), F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)["out"]).otherwise(F.array().cast(kind))

    return F.coalesce(F.concat(*[spans(k, p) for k, p in domain.PII.items()]), F.array().cast(kind))


def bucket100(text: Column) -> Column:
    """The 128-bit md5 of ``text`` modulo 100, from its four 32-bit parts."""
    digest = F.md5(text)
    part = lambda i: F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
    return F.pmod(part(0) * 36 + part(1) * 16 + part(2) * 96 + part(3), F.lit(100)).cast("int")


def rank_key(key: Column, seed: int) -> Column:
    """A reproducible random order: the md5 of key and seed."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def strict_json(text: Column) -> Column:
    """The variant of a JSON text, null unless the whole text is one JSON value.

    The parser stops after one value, so the text must fit a list as its only item and an object
    as its only field: no text can close both early.  Parse into a column of its own where
    several fields are read.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    fielded = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    extra = F.try_variant_get(listed, "$[1]", "variant")
    return F.when(listed.isNotNull() & extra.isNull(), F.try_variant_get(fielded, "$.v", "variant"))


def is_object(value: Column) -> Column:
    """Whether a variant is a JSON object; false for null."""
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def json_field(value: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, f"$.{name}", kind)


def model_json(text: Column) -> Column:
    """JSON of a model's answer: without thinking blocks and fence lines."""
    bare = F.regexp_replace(text, r"(?s)<think>.*?</think>", "")
    lines = F.filter(F.split(bare, "\n"), lambda line: ~strip(line).startswith("```"))
    return strict_json(strip(F.array_join(lines, "\n")))


def extract_json(text: Column) -> Column:
    """JSON of the text itself, else of a fenced block, else from the first to the last brace."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.coalesce(strict_json(strip(text)), *[strict_json(F.nullif(x, F.lit(""))) for x in (fenced, braces)])


def is_valid_output(value: Column) -> Column:
    """Whether a variant has the six fields of a structured answer with their types."""
    kind = lambda n: F.schema_of_variant(F.try_variant_get(value, f"$.{n}", "variant"))
    texts = [kind(n) == "STRING" for n in ("intent", "urgency", "reasoning", "response")]
    lists = [kind(n).isin("ARRAY<STRING>", "ARRAY<VOID>") for n in ("workflow_steps", "tools_required")]
    out = F.lit(True)
    for x in [*texts, *lists]:
        out = out & F.coalesce(x, F.lit(False))
    return out


def joined_distance_score(pred: Column, gold: Column) -> Column:
    """One less the edit distance of the lists joined by arrows over the longer; empty gold: 1 if
    the prediction is empty, else 0."""
    p, g = F.array_join(pred, " → "), F.array_join(gold, " → ")
    longest = F.greatest(F.length(p), F.length(g))
    return F.when(F.size(gold) == 0, (F.size(pred) == 0).cast("double")).otherwise(1.0 - F.levenshtein(p, g) / longest)


def token_distance_score(pred: Column, gold: Column) -> Column:
    """The same over list items (trimmed, lower case), each distinct one written as one character.

    The characters lie beyond the basic plane, for up to a million distinct items a row; both empty 1, one empty 0.
    """
    clean = lambda a: F.transform(a, lambda t: F.lower(strip(t)))

    def scored(x: Column) -> Column:
        p, g, names = x["p"], x["g"], x["names"]
        code = lambda a: F.array_join(F.transform(a, lambda t: F.decode(F.unhex(F.lpad(F.hex(F.array_position(names, t) + 0xFFFF), 8, "0")), "UTF-32")), "")
        score = 1.0 - F.levenshtein(code(p), code(g)) / F.greatest(F.size(p), F.size(g))
        return F.when((F.size(p) == 0) & (F.size(g) == 0), 1.0).when((F.size(p) == 0) | (F.size(g) == 0), 0.0).otherwise(score)

    return bound(F.struct(clean(pred).alias("p"), clean(gold).alias("g")), lambda x: bound(F.struct(x["p"].alias("p"), x["g"].alias("g"), F.array_distinct(F.concat(x["p"], x["g"])).alias("names")), scored))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def set_f1(pred: Column, gold: Column) -> Column:
    """F1 of two lists as sets; both empty 1."""
    both = F.size(F.array_intersect(pred, gold))
    total = F.size(F.array_distinct(pred)) + F.size(F.array_distinct(gold))
    return F.when(total == 0, 1.0).otherwise(2.0 * both / total)


def tool_names(calls: Column) -> Column:
    """Distinct names of calls such as ``name(x=1)``, trimmed and lower case."""
    return F.array_distinct(F.filter(F.transform(calls, lambda t: F.lower(strip(F.substring_index(t, "(", 1)))), lambda t: t != ""))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def clean_response(text: Column) -> Column:
    """Stripped, without quotes around it, escaped line ends and quotes resolved."""
    t = strip(text)
    t = F.when(t.startswith('"') & t.endswith('"') & (F.length(t) > 1), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)
    return F.replace(F.replace(t, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"'))


def escalated_urgency(base: Column, message: Column) -> Column:
    return urgency_in(base, F.lower(message))


def urgency_in(base: Column, low: Column) -> Column:
    """The same for a message in lower case already."""
    raised = F.when(base == "low", "medium").when(base == "medium", "high").otherwise(base)
    return F.when(any_in(low, domain.CRITICAL_WORDS), "critical").when(any_in(low, domain.URGENT_WORDS), raised).otherwise(base)


def parsed_response(raw: Column) -> Column:
    """The six fields of an answer with their defaults: intent unknown, urgency medium, empty lists
    and reasoning, and the raw text as its response."""
    parsed = extract_json(raw)
    listed = lambda n: F.coalesce(json_field(parsed, n, "array<string>"), F.array().cast("array<string>")).alias(n)
    field = lambda n, default: F.coalesce(json_field(parsed, n), default).alias(n)
    return F.struct(field("intent", F.lit("unknown")), field("urgency", F.lit("medium")), field("reasoning", F.lit("")), listed("workflow_steps"), listed("tools_required"), field("response", raw))


def urgency_badge(urgency: Column) -> Column:
    """An HTML mark of an urgency in its colour, grey for an unknown one."""
    color = lookup(domain.URGENCY_COLORS, F.lower(urgency), "#6b7280")
    return F.format_string('<span style="background:%s;color:white">%s</span>', color, F.upper(urgency))


def user_prompt(message: Column, reply: Column) -> Column:
    """The text given to an annotator: the message, and the reply if there is one."""
    return F.concat_ws("\n", F.concat(F.lit("Customer message: "), message), F.concat(F.lit("Agent response: "), reply))
