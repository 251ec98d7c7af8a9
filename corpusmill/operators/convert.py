"""Records to chat messages, and what is read from chat messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators.quality import first_of_each


def message(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def triple(user: Column, assistant: Column, system: str = domain.SYSTEM_PROMPT) -> Column:
    return F.array(message("system", F.lit(system)), message("user", user), message("assistant", assistant))


def structured_answer(intent: Column, urgency: Column, steps: Column, tools: Column, reasoning: Column, response: Column) -> Column:
    named = {"intent": intent, "urgency": urgency, "workflow_steps": steps, "tools_required": tools, "reasoning": reasoning, "response": response}
    return F.to_json(F.struct(*[c.alias(n) for n, c in named.items()]))


def _list_of(table: Mapping[str, Sequence[str]], key: Column, default: Sequence[str]) -> Column:
    words = lambda v: F.array(*map(F.lit, v))
    return F.coalesce(F.try_element_at(F.create_map(*[x for k, v in table.items() for x in (F.lit(k), words(v))]), key), words(default))


def _field(df: DataFrame, *names: str, default: str = "") -> Column:
    found = [F.col(n).cast("string") for n in names if n in df.columns]
    return F.coalesce(*found, F.lit(default)) if found else F.lit(default)


def from_category(df: DataFrame) -> DataFrame:
    """Category tickets: intent and urgency from the category, raised by the message's words."""
    user, category, said = _field(df, "customer_message", "instruction"), F.upper(_field(df, "category")), _field(df, "intent")
    intent = tx.lookup(domain.CATEGORY_INTENT, category, "general_inquiry")
    urgency = tx.escalated_urgency(tx.lookup(domain.CATEGORY_URGENCY, category, "medium"), user)
    steps, tools = _list_of(domain.CATEGORY_STEPS, intent, ("assess_request", "resolve_issue")), _list_of(domain.CATEGORY_TOOLS, intent, ("ticket_update_api",))
    reasoning = _sentence(domain.CATEGORY_REASONING, intent, said, urgency)
    answer = structured_answer(intent, urgency, steps, tools, reasoning, _field(df, "agent_response", "response"))
    return df.withColumns({"intent_out": intent, "urgency_out": urgency, "messages": triple(user, answer)})


def from_queue(df: DataFrame) -> DataFrame:
    """Queue tickets: intent from the queue, urgency from the priority."""
    user, queue, priority = _field(df, "customer_message", "body"), _field(df, "queue", default="Customer Service"), _field(df, "priority", "urgency", default="medium")
    intent = tx.lookup(domain.QUEUE_INTENT, queue, "general_inquiry")
    urgency = tx.escalated_urgency(F.when(priority.isin("high", "medium", "low"), priority).otherwise("medium"), user)
    steps, tools = _list_of(domain.QUEUE_STEPS, intent, ("assess_request", "resolve_issue")), _list_of(domain.QUEUE_TOOLS, intent, ("ticket_update_api",))
    reasoning = _sentence(domain.QUEUE_REASONING, queue, priority, _field(df, "type"), intent)
    answer = structured_answer(intent, urgency, steps, tools, reasoning, _field(df, "agent_response", "response", "answer"))
    return df.withColumns({"intent_out": intent, "urgency_out": urgency, "messages": triple(user, answer)})


def _sentence(parts: Sequence[str], *values: Column) -> Column:
    """The fixed parts of a sentence with the values between them."""
    return F.concat(*[x for i, p in enumerate(parts) for x in (F.lit(p), *values[i : i + 1])])


def named_label(df: DataFrame, column: str, names: Sequence[str]) -> Column:
    """A label by its number among ``names``; else its text in lower case with underscores."""
    text = F.replace(F.lower(F.col(column).cast("string")), F.lit(" "), F.lit("_"))
    if not names or df.schema[column].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return F.coalesce(text, F.lit(""))
    number = F.col(column)
    known = F.when(number.between(0, len(names) - 1), F.get(F.array(*map(F.lit, names)), number.cast("int")))
    return F.coalesce(known, text, F.lit(""))


def _from_label(df: DataFrame, user: Column, label: Column, intents: Mapping[str, str], urgencies: Mapping[str, str], defaults: tuple[Sequence[str], Sequence[str]], sentence: Sequence[str]) -> DataFrame:
    """Messages of a labelled text; ``defaults``: steps and tools of an intent without its own."""
    intent = tx.lookup(intents, label, "general_inquiry")
    urgency = tx.escalated_urgency(tx.lookup(urgencies, label, "medium"), user)
    steps, tools = _list_of(domain.CATEGORY_STEPS, intent, defaults[0]), _list_of(domain.CATEGORY_TOOLS, intent, defaults[1])
    plain, out = F.replace(label, F.lit("_"), F.lit(" ")), label == "oos"
    reasoning = F.when(out, domain.OUT_OF_SCOPE_REASONING).otherwise(_sentence(domain.LABEL_REASONING, plain, intent, urgency))
    response = F.when(out, domain.OUT_OF_SCOPE_RESPONSE).otherwise(_sentence(sentence, plain))
    return df.withColumns({"intent_out": intent, "urgency_out": urgency, "messages": triple(user, structured_answer(intent, urgency, steps, tools, reasoning, response))})


def from_banking(df: DataFrame, column: str = "label") -> DataFrame:
    """Banking messages: intent and urgency from the label (a name, or its place among all in order)."""
    label = named_label(df, column, sorted(domain.BANKING_INTENT))
    return _from_label(df, _field(df, "text", "customer_message"), label, domain.BANKING_INTENT, domain.BANKING_URGENCY, (("verify_identity", "resolve_issue"), ("customer_profile_api",)), domain.BANKING_RESPONSE)


def from_scope_labels(df: DataFrame, column: str = "intent", names: Sequence[str] = domain.SCOPE_NAMES) -> DataFrame:
    """Messages of the out-of-scope set, where ``oos`` goes to a person; ``names``: what label numbers stand for."""
    column = column if column in df.columns else "label"
    label = named_label(df, column, names)
    return _from_label(df, _field(df, "text"), label, domain.SCOPE_INTENT, domain.SCOPE_URGENCY, (("assess_request", "provide_information"), ("ticket_update_api",)), domain.SCOPE_RESPONSE)


def service_labels(df: DataFrame, column: str = "intent", names: Sequence[str] = domain.SCOPE_NAMES, allowed: Sequence[str] = domain.SERVICE_LABELS) -> DataFrame:
    """Rows of the out-of-scope set whose label, by name or number, is one that a customer service
    sees; no filter without the column."""
    if column not in df.columns:
        return df
    kind = df.schema[column].dataType.typeName()
    label = named_label(df, column, names) if kind in ("byte", "short", "integer", "long") else F.col(column).cast("string")
    return df.where(label.isin(*allowed))


def from_preference(df: DataFrame) -> DataFrame:
    """prompt, chosen and rejected, each an empty list where it is null."""
    return df.select(*[F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType)).alias(c) for c in ("prompt", "chosen", "rejected")])


def _turns(df: DataFrame, column: str, roles: Mapping[str, str], fallback: Column) -> DataFrame:
    """Turns with from/value or role/content (or any of them) as messages, a system prompt first;
    a null or empty list gives ``fallback`` as the user's only message."""
    fields = set(df.schema[column].dataType.elementType.fieldNames())
    part = lambda t, names, default: F.coalesce(*[t[n].cast("string") for n in names if n in fields], F.lit(default))

    def one(t: Column) -> Column:
        role = part(t, ("from", "role"), "user")
        named = reduce(lambda w, kv: w.when(role == kv[0], kv[1]), roles.items(), F)
        return message(named.otherwise(role), part(t, ("value", "content"), ""))

    turns = F.transform(column, one)
    with_system = F.when(F.exists(turns, lambda m: m["role"] == "system"), turns).otherwise(F.concat(F.array(message("system", F.lit(domain.SYSTEM_PROMPT))), turns))
    return df.withColumn("messages", F.when(F.size(column) > 0, with_system).otherwise(triple(fallback, F.lit(""))))


def from_turns(df: DataFrame, column: str = "conversations") -> DataFrame:
    """Turn lists: human and gpt get their roles; without turns the text is the user's message."""
    return _turns(df, column, {"human": "user", "gpt": "assistant"}, _field(df, "text"))


def from_tool_chains(df: DataFrame, column: str = "conversations") -> DataFrame:
    """The same where an observation is a tool's message; without turns the query, or else the
    whole row as JSON, is the user's message."""
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    fallback = F.coalesce(F.col("query").cast("string"), whole) if "query" in df.columns else whole
    return _turns(df, column, {"human": "user", "gpt": "assistant", "observation": "tool"}, fallback)


def from_marked_text(df: DataFrame, column: str = "chat") -> DataFrame:
    """Text with SYSTEM:, USER:, ASSISTANT:, FUNCTION_CALL: and FUNCTION_RESPONSE: marks; a list of
    messages passes through, with user as the role where there is none."""
    column = next((c for c in (column, "text", "conversations") if c in df.columns), column)
    if df.schema[column].dataType.typeName() == "array":
        fields = set(df.schema[column].dataType.elementType.fieldNames())
        part = lambda t, n, default: F.coalesce(t[n], F.lit(default)) if n in fields else F.lit(default)
        return df.withColumn("messages", F.coalesce(F.transform(column, lambda t: message(part(t, "role", "user"), part(t, "content", ""))), triple(F.lit(""), F.lit(""))))
    marks = "SYSTEM:|USER:|ASSISTANT:|FUNCTION_CALL:|FUNCTION_RESPONSE:"
    pattern = F.lit(f"(?s)({marks})(.*?)(?={marks}|$)")
    roles = {"SYSTEM:": "system", "USER:": "user", "ASSISTANT:": "assistant", "FUNCTION_CALL:": "assistant", "FUNCTION_RESPONSE:": "tool"}
    parts = F.zip_with(F.regexp_extract_all(column, pattern, 1), F.regexp_extract_all(column, pattern, 2), lambda r, b: message(tx.lookup(roles, r, "user"), tx.strip(b)))
    found = F.filter(parts, lambda m: m["content"] != "")
    return df.withColumn("messages", F.when(F.size(found) >= 2, found).otherwise(triple(F.coalesce(column, F.lit("")), F.lit(""))))


def from_function_calls(df: DataFrame) -> DataFrame:
    """query, tools and answers (JSON text, kept as it is; broken JSON, an empty value or null is an empty list)."""
    text = lambda c: tx.strip(_field(df, c))
    known = df.withColumns({f"{c}__": F.when(tx.strict_json(text(c)).isNotNull() & ~text(c).isin("[]", "{}", "null", '""', "0", "false"), text(c)) for c in ("tools", "answers")})
    body = F.coalesce("answers__", F.lit(domain.NO_TOOL_CALL))
    system = F.concat(F.lit(domain.SYSTEM_PROMPT), F.coalesce(F.concat(F.lit(domain.TOOL_SCHEMAS_HEAD), "tools__"), F.lit("")))
    return known.withColumn("messages", F.array(message("system", system), message("user", _field(df, "query")), message("assistant", body))).drop("tools__", "answers__")


def from_annotated(df: DataFrame) -> DataFrame:
    """Annotated rows: the reasoning joins the steps by arrows; missing fields have their defaults."""
    listed = lambda n: F.coalesce(F.col(n), F.array().cast("array<string>")) if n in df.columns else F.array().cast("array<string>")
    steps, urgency = listed("workflow_steps"), _field(df, "urgency", default="medium")
    reasoning = _sentence(domain.ANNOTATED_REASONING, _field(df, "intent", default="unknown"), urgency, F.array_join(steps, " → "))
    answer = structured_answer(_field(df, "intent", default="general_inquiry"), urgency, steps, listed("tools_required"), reasoning, _field(df, "agent_response"))
    return df.withColumn("messages", triple(_field(df, "customer_message"), answer))


CONVERTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "category": from_category, "queue": from_queue, "turns": from_turns, "tool_chains": from_tool_chains, "marked_text": from_marked_text, "function_calls": from_function_calls,
    "annotated": from_annotated, "banking": from_banking, "scope_labels": from_scope_labels, "preference": from_preference,
    # by the name of the public data set whose form it is
    "bitext": from_category, "safety": from_category, "ticket": from_queue, "glaive": from_marked_text, "xlam": from_function_calls, "hermes": from_turns, "arcee_agent": from_turns,
    "t1": from_turns, "toolbench": from_tool_chains, "toolace": from_tool_chains, "banking77": from_banking, "clinc": from_scope_labels,
}


def converter(name: str) -> Callable[[DataFrame], DataFrame]:
    if name not in CONVERTERS:
        raise ValueError(f"unknown converter {name!r}; known: {', '.join(sorted(CONVERTERS))}")
    return CONVERTERS[name]


def convert_rows(df: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """The messages of every row by the named converter, without the source's columns but ``keep``
    (``preference`` gives prompt, chosen and rejected instead).

    A row that the converter makes nothing of becomes a triple with the row's JSON as the user's
    message and an empty answer, so no row is lost.
    """
    done = converter(name)(df)
    if "messages" not in done.columns:
        return done
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return done.select(*keep, F.coalesce("messages", triple(whole, F.lit(""))).alias("messages"))


def convert_and_keep(df: DataFrame, name: str, source: str, *, key: str, language: str | None = None, service_only: bool = False, most: int | None = None, seed: int = 42) -> DataFrame:
    """The preparation of one source: filter by language and label, convert, keep what is a
    dialogue with an answer, name the source, and cut to ``most`` rows after that.

    Filters act only where their column is there; the cut takes the first rows in the order of the
    md5 of key and seed.  Gives key, messages and source.
    """
    if language is not None and "language" in df.columns:
        df = df.where(F.col("language") == language)
    if service_only:
        df = service_labels(df)
    answered = F.exists("messages", lambda m: (m["role"] == "assistant") & (tx.strip(F.coalesce(m["content"], F.lit(""))) != ""))
    out = convert_rows(df, name, [key]).where((F.size("messages") >= 2) & answered).withColumn("source", F.lit(source))
    return out if most is None else out.orderBy(tx.rank_key(F.col(key), seed), key).limit(most)


def prompt_rows(df: DataFrame, message_column: str = "customer_message") -> DataFrame:
    """Prompts without an answer, for training by reward: the system's and the user's message."""
    return df.withColumn("prompt", F.array(message("system", F.lit(domain.SYSTEM_PROMPT)), message("user", F.col(message_column))))


def completion_rows(df: DataFrame, message_column: str, completion: str, good: Column) -> DataFrame:
    """Prompt, completion and whether it is a good one, for training by a binary label."""
    return prompt_rows(df, message_column).select(*[c for c in df.columns if c not in ("prompt", "completion", "label")], "prompt", F.col(completion).alias("completion"), good.alias("label"))


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Every leaf of nested structs as a column of its own, named by its path."""

    def leaves(fields, path: tuple[str, ...]):
        for f in fields:
            here = (*path, f.name)
            if f.dataType.typeName() == "struct":
                yield from leaves(f.dataType.fields, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here))

    return df.select(*leaves(df.schema.fields, ()))


def threads(turns: DataFrame) -> DataFrame:
    """One row a conversation: its messages in order of the turn."""
    packed = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(packed.alias("m")).select("conv_id", F.transform("m", lambda t: message(t["role"], t["content"])).alias("messages"))


def has_dialogue(messages: Column) -> Column:
    """Two messages or more, with a user and an assistant that says something."""
    said = F.exists(messages, lambda m: (m["role"] == "assistant") & (tx.strip(m["content"]) != ""))
    return (F.size(messages) >= 2) & F.exists(messages, lambda m: m["role"] == "user") & said


def is_complete_example(messages: Column) -> Column:
    """Whether a chat can be trained on: system, user and assistant are there, every answer with
    content is JSON with intent and response, and a tool's message follows every call."""
    has = lambda r: F.exists(messages, lambda m: m["role"] == r)

    def fine(m: Column) -> Column:
        said = F.coalesce(m["content"], F.lit(""))
        parsed = tx.strict_json(said)
        fields = F.try_variant_get(parsed, "$.intent", "variant").isNotNull() & F.try_variant_get(parsed, "$.response", "variant").isNotNull()
        return (m["role"] != "assistant") | (said == "") | F.coalesce(fields, F.lit(False))

    return has("system") & has("user") & has("assistant") & F.forall(messages, fine) & tool_calls_answered(messages)


def render(messages: Column) -> Column:
    """The plain chat template; a null content is empty."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit("<|im_end|>"))), "\n")


def dialogue_digest(messages: Column) -> Column:
    """md5 over role and content of all messages but the system's."""
    kept = F.filter(messages, lambda m: m["role"] != "system")
    return F.md5(F.array_join(F.transform(kept, lambda m: F.concat_ws(":", m["role"], F.coalesce(m["content"], F.lit("")))), "|"))


def dedup_messages(chats: DataFrame, key: str = "conv_id") -> DataFrame:
    """The first conversation, by key, of each digest; of repeated rows one."""
    return first_of_each(chats, dialogue_digest(F.col("messages")), key)


def last_user(messages: Column) -> Column:
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == "user"), F.lit(-1))["content"]


def stated_intent(messages: Column) -> Column:
    """The intent in the last assistant message that is a JSON object with one, else general_inquiry."""
    stated = F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: tx.json_field(tx.strict_json(m["content"]), "intent"))
    return F.coalesce(F.try_element_at(F.filter(stated, lambda x: x.isNotNull()), F.lit(-1)), F.lit("general_inquiry"))


def enriched(steps: Column, tools: Column, urgency: Column) -> dict[str, Column]:
    """Enrichment after its checks: up to six steps, up to four known tools, urgency or medium."""
    known = F.filter(tools, lambda t: t.isin(*domain.TOOL_PARAMETERS))
    return {"steps": F.slice(steps, 1, 6), "tools": F.slice(known, 1, 4), "urgency": F.when(urgency.isin(*domain.URGENCIES), urgency).otherwise("medium")}


def apply_enrichment(messages: Column, steps: Column, tools: Column, urgency: Column) -> Column:
    """Messages whose structured assistant answers get the steps, tools and urgency; others stay."""
    new = enriched(steps, tools, urgency)

    def one(m: Column) -> Column:
        parsed = tx.strict_json(m["content"])
        field = lambda n: tx.json_field(parsed, n).alias(n)
        body = F.to_json(F.struct(field("intent"), new["urgency"].alias("urgency"), new["steps"].alias("workflow_steps"), new["tools"].alias("tools_required"), field("reasoning"), field("response")))
        fits = (m["role"] == "assistant") & F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False)) & (F.size(steps) > 0)
        return message(m["role"], F.when(fits, body).otherwise(m["content"]))

    return F.transform(messages, one)


PAIR = "struct<prompt:array<struct<role:string,content:string>>,chosen:array<struct<role:string,content:string>>,rejected:array<struct<role:string,content:string>>>"


def preferred_turns(chosen: Column, rejected: Column) -> Column:
    """prompt (chosen's turns but the assistant's), chosen and rejected (the assistant's turns); null
    if either has none or both say the same."""
    said = lambda c: F.filter(c, lambda m: m["role"] == "assistant")
    prompt = F.filter(chosen, lambda m: m["role"] != "assistant")
    pair = F.struct(prompt.alias("prompt"), said(chosen).alias("chosen"), said(rejected).alias("rejected"))
    return F.when((F.size(said(chosen)) > 0) & (F.size(said(rejected)) > 0) & (said(chosen) != said(rejected)), pair)


def _pair(df: DataFrame, prompt: Column, chosen: Column, rejected: Column, quality: Column | None, when: Column) -> DataFrame:
    pair = F.when(when, F.struct(prompt.alias("prompt"), chosen.alias("chosen"), rejected.alias("rejected")).cast(PAIR))
    waits = F.when(when, (F.size(chosen) == 0) | (F.size(rejected) == 0)) if quality is not None else F.when(when, F.lit(False))
    return df.withColumns({"pair": pair, "quality": F.lit(None).cast("double") if quality is None else F.when(when, quality), "needs_pairing": waits})


def pairs_from_attributes(df: DataFrame, high: float = 4.0, low: float = 2.0) -> DataFrame:
    """Adds pair, quality and needs_pairing from the attribute scores of single responses.

    With chosen and rejected the row passes through (texts become the assistant's message).  Else
    the quality is the mean of helpfulness and correctness (3 where missing): from ``high`` on the
    response is chosen, up to ``low`` rejected, each to be paired later; between them pair is null.
    """
    says = lambda c: F.array(message("assistant", c))
    listed = lambda n: F.col(n) if df.schema[n].dataType.typeName() == "array" else says(F.col(n))
    none = F.array().cast("array<struct<role:string,content:string>>")
    if {"chosen", "rejected"} <= set(df.columns):
        prompt = none if "prompt" not in df.columns else F.col("prompt") if df.schema["prompt"].dataType.typeName() == "array" else F.array(message("user", F.col("prompt")))
        return _pair(df, prompt, listed("chosen"), listed("rejected"), None, F.lit(True))
    score = lambda n: F.coalesce(F.col(n).cast("double"), F.lit(3.0)) if n in df.columns else F.lit(3.0)
    quality = (score("helpfulness") + score("correctness")) / 2.0
    good, bad = quality >= high, quality <= low
    said = says(_field(df, "response"))
    return _pair(df, F.array(message("user", _field(df, "prompt"))), F.when(good, said).otherwise(none), F.when(bad, said).otherwise(none), quality, good | bad)


def pairs_from_binarized(df: DataFrame) -> DataFrame:
    """Adds pair, quality (null) and needs_pairing (false) from chosen and rejected message lists: the
    prompt is what isn't the assistant's in chosen, or else the prompt's or instruction's text; null
    if either list is null or empty."""
    said = lambda c: F.filter(c, lambda m: m["role"] == "assistant")
    asked = F.filter("chosen", lambda m: m["role"] != "assistant")
    prompt = F.when(F.size(asked) > 0, asked).otherwise(F.array(message("user", _field(df, "prompt", "instruction"))))
    there = F.coalesce((F.size("chosen") > 0) & (F.size("rejected") > 0), F.lit(False))
    return _pair(df, prompt, said(F.col("chosen")), said(F.col("rejected")), None, there)


def pairs_from_satisfaction(df: DataFrame, conversation: str, score: str, prompt: str) -> DataFrame:
    """Adds pair, quality and needs_pairing from a customer's score (cut to an integer): 4 and more
    make the conversation chosen, 2 and less rejected; 3 and null give no pair."""
    whole = F.col(score).cast("int")
    none = F.array().cast("array<struct<role:string,content:string>>")
    said = F.array(message("assistant", F.col(conversation)))
    good, bad = F.coalesce(whole >= 4, F.lit(False)), F.coalesce(whole <= 2, F.lit(False))
    return _pair(df, F.col(prompt), F.when(good, said).otherwise(none), F.when(bad, said).otherwise(none), whole.cast("double"), good | bad)


PAIR_STRATEGIES: dict[str, Callable[[DataFrame], DataFrame]] = {"attributes": pairs_from_attributes, "binarized": pairs_from_binarized, "helpsteer": pairs_from_attributes, "ultrafeedback": pairs_from_binarized}


def build_pairs(df: DataFrame, strategy: str) -> DataFrame:
    """The rows of which the named strategy makes a pair, with pair, quality and needs_pairing."""
    if strategy not in PAIR_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; known: {', '.join(sorted(PAIR_STRATEGIES))}")
    return PAIR_STRATEGIES[strategy](df).where("pair IS NOT NULL")


def pair_errors(pair: Column) -> Column:
    """What is wrong with a pair: an empty prompt, chosen or rejected, or both the same."""
    size = lambda n: F.coalesce(F.size(pair[n]), F.lit(0))
    empty = [F.when(size(n) == 0, F.lit(f"empty_{n}")) for n in ("prompt", "chosen", "rejected")]
    return F.array_compact(F.array(*empty, F.when((size("chosen") > 0) & pair["chosen"].eqNullSafe(pair["rejected"]), F.lit("chosen_is_rejected"))))


def validate_pairs(df: DataFrame) -> DataFrame:
    """Built pairs that don't wait for a partner, with errors (empty for a valid pair)."""
    return df.where(~F.coalesce("needs_pairing", F.lit(False))).withColumn("errors", pair_errors(F.col("pair")))


def tool_calls_answered(messages: Column) -> Column:
    """Whether a tool's message follows every assistant message that is a call (JSON with a name)."""
    call = lambda m: (m["role"] == "assistant") & F.coalesce(tx.json_field(tx.strict_json(m["content"]), "name").isNotNull(), F.lit(False))
    places = F.sequence(F.lit(1), F.greatest(F.size(messages), F.lit(1)))
    at = lambda i: F.try_element_at(messages, i)
    return F.forall(places, lambda i: ~F.coalesce(call(at(i)), F.lit(False)) | F.coalesce(at(i + 1)["role"] == "tool", F.lit(False)))
