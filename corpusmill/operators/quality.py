"""Filters, exact and semantic dedup, class balance and the report over a chain of filters."""

from __future__ import annotations

import inspect
import warnings
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators.order import heads

#: Kept vectors that the greedy semantic dedup looks back on.
LOOK_BACK = 100


def _guarded(df: DataFrame, column: str, condition: Column) -> DataFrame:
    return df.where(condition) if column in df.columns else df


def filter_length(df: DataFrame, column: str = "text", least: int = 10, most: int = 2000) -> DataFrame:
    """Rows with ``least`` to ``most`` words; no filter without the column."""
    return _guarded(df, column, tx.word_count(F.col(column)).between(least, most))


def filter_language(df: DataFrame, column: str = "text", allowed: Sequence[str] = ("en",), most: float = 0.3) -> DataFrame:
    """If English is allowed: texts that aren't empty and have under ``most`` characters beyond ASCII."""
    if "en" not in allowed:
        return df
    return _guarded(df, column, (F.length(column) > 0) & (tx.non_ascii_share(F.col(column)) < most))


def filter_at_least(df: DataFrame, column: str, least: float) -> DataFrame:
    """Confidence and quality filter; a value that is no number fails the query."""
    return _guarded(df, column, F.col(column).cast("double") >= least)


def filter_confidence(df: DataFrame, column: str = "confidence", least: float = 0.8) -> DataFrame:
    return filter_at_least(df, column, least)


def filter_quality_score(df: DataFrame, column: str = "quality_score", least: float = 3.0) -> DataFrame:
    return filter_at_least(df, column, least)


def filter_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    return _guarded(df, column, F.col(column) == value)


def first_of_each(df: DataFrame, digest: Column, key: str) -> DataFrame:
    """One row of each value of ``digest``: that with the smallest key (null first), and of rows
    with one key that with the smallest columns.

    One pass: rows of a value meet in a map-side minimum first, so a value that a third of all rows
    hold crosses the network once a task.
    """
    plain = [f.name for f in df.schema.fields if f.name != key and _orderable(f.dataType)]
    order = F.struct(F.col(key), *plain)
    row = F.struct(*df.columns)
    return df.groupBy(digest.alias("digest__")).agg(F.min_by(row, order).alias("row__")).select("row__.*")


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedup_exact(df: DataFrame, column: str = "text", key: str = "doc_id") -> DataFrame:
    """The first row, by key, of each value; nulls are one value, and equal to the text None."""
    if column not in df.columns:
        return df
    return first_of_each(df, F.md5(F.coalesce(F.col(column).cast("string"), F.lit("None"))), key)


def dedup_semantic(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Keys kept by a greedy scan in key order: a row goes if its cosine with any of the last
    LOOK_BACK rows kept is ``threshold`` or more.

    This is the order-dependent form: every decision depends on those before it, so one task
    streams the rows, with LOOK_BACK vectors in memory.  For large tables use
    ``dedup_semantic_neighbours``.  Null vectors and those of length 0 are left out.
    """
    import numpy as np
    import pandas as pd

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[np.ndarray] = []
        for part in parts:
            keys = []
            for k, v in zip(part["k"], part["v"]):
                v = np.asarray(v, np.float64)
                size = np.sqrt((v**2).sum())
                if not size > 0:
                    continue
                v = v / size
                if not kept or not (np.stack(kept) @ v >= threshold).any():
                    kept = [*kept[1 - LOOK_BACK :], v] if len(kept) >= LOOK_BACK else [*kept, v]
                    keys.append(k)
            yield pd.DataFrame({key: np.array(keys, np.int64)})

    rows = df.select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v")).where("v IS NOT NULL")
    return rows.coalesce(1).sortWithinPartitions("k").mapInPandas(scan, f"`{key}` long")


def unit(vector: Column) -> Column:
    """``vector`` in double precision with length 1; null for null, and for a vector of length 0."""
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.when(squares > 0, F.transform(vector, lambda x: x.cast("double") / F.sqrt(squares)))


def dedup_semantic_neighbours(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding", window: int = 1000) -> DataFrame:
    """Keys without an earlier neighbour: a row goes if its cosine with any row, kept or not, whose
    key is up to ``window`` less, is ``threshold`` or more.

    The scalable form of the semantic dedup, for an integer key that numbers the rows: the look-back is
    a join by blocks of ``window`` keys, where each block meets itself and the block before.  Blocks
    are independent, and a task holds the vectors of two at a time.  Rows that share a key are not each other's
    neighbours; null vectors and keys and vectors of length 0 are left out.
    """
    import numpy as np
    import pyarrow as pa

    rows = df.select(F.col(key).cast("long").alias("k"), unit(F.col(vector)).alias("v")).where("k IS NOT NULL AND v IS NOT NULL")
    own = F.floor(F.col("k") / window)
    met = rows.select("k", "v", F.explode(F.array(F.struct(own.alias("b"), F.lit(True).alias("own")), F.struct((own + 1).alias("b"), F.lit(False).alias("own")))).alias("x")).select("k", "v", "x.b", "x.own")

    def scan(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys, mine = table.column("k").to_numpy(), table.column("own").to_numpy(zero_copy_only=False)
        kept = []
        if mine.any():
            vectors = np.array(table.column("v").to_pylist(), np.float64)
            order = np.argsort(keys, kind="stable")
            sorted_keys, sorted_vectors = keys[order], vectors[order]
            for i in np.flatnonzero(mine):
                a, b = np.searchsorted(sorted_keys, (keys[i] - window, keys[i]))
                if a == b or not (sorted_vectors[a:b] @ vectors[i] >= threshold).any():
                    kept.append(keys[i])
        return pa.table({key: pa.array(kept, pa.int64())})

    return met.groupBy("b").applyInArrow(scan, f"`{key}` long")


def balance_classes(df: DataFrame, column: str = "intent", share: float = 0.3, key: str = "event_id", seed: int = 42) -> DataFrame:
    """Cuts each class to ``int(rows * share)``, in an order by md5 of key and seed; null is a class.

    Classes within the cap stay as they are and need no order; in the others rows are numbered by
    counted buckets of the md5, and no task orders a whole class.
    """
    if column not in df.columns:
        return df
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg(F.floor(F.sum("n") * F.lit(share)).alias("cap"))
    return heads(df, column, sizes.crossJoin(F.broadcast(whole)).select(F.col(column).alias("class"), "n", "cap"), key, seed)


def edge_case_share(df: DataFrame, column: str = "intent", values: Sequence[str] = domain.EDGE_INTENTS) -> DataFrame:
    return df.agg(F.avg(F.col(column).isin(*values).cast("double")).alias("edge_share"))


def filter_report(df: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """(stage, before, after, removed) of filters one after the other, in one pass."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("c0")]
    for i, (_, condition) in enumerate(stages, 1):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(f"c{i}"))
    one = df.agg(*counts)
    lines = [F.struct(F.lit(name).alias("stage"), F.col(f"c{i - 1}").alias("before"), F.col(f"c{i}").alias("after"), (F.col(f"c{i - 1}") - F.col(f"c{i}")).alias("removed")) for i, (name, _) in enumerate(stages, 1)]
    return one.select(F.inline(F.array(*lines)))


#: The filters that a configuration may name.
FILTERS: dict[str, Callable[..., DataFrame]] = {
    "dedup_exact": dedup_exact, "dedup_semantic": dedup_semantic_neighbours, "filter_length": filter_length, "filter_language": filter_language, "filter_confidence": filter_confidence,
    "filter_quality_score": filter_quality_score, "balance_intents": balance_classes, "ensure_edge_cases": lambda df, **_: df,
}
DEFAULT_FILTERS = ("dedup_exact", "filter_length", "filter_language", "filter_confidence", "balance_intents", "ensure_edge_cases")


def apply_all(df: DataFrame, config: Mapping[str, Mapping | None] | None = None, **common: str) -> tuple[DataFrame, DataFrame]:
    """(what is left, report) of the named filters in turn, each with its options; by default
    DEFAULT_FILTERS.  Unknown names are skipped with a warning, and filters whose column is missing do nothing.

    ``common`` are options for all filters that know them, such as ``column`` or ``key``.  The
    report is (i, stage, before, after, removed): one count of the rows after each stage.
    """
    config = dict.fromkeys(DEFAULT_FILTERS) if config is None else config
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(0).alias("i"), F.lit("").alias("stage"), "n")]
    for name, options in config.items():
        if name not in FILTERS:
            warnings.warn(f"unknown filter {name!r} skipped", stacklevel=2)
            continue
        known = inspect.signature(FILTERS[name]).parameters
        df = FILTERS[name](df, **({k: v for k, v in common.items() if k in known} | dict(options or {})))
        counts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(len(counts)).alias("i"), F.lit(name).alias("stage"), "n"))
    line = Window.orderBy("i")
    report = reduce(DataFrame.union, counts).withColumn("before", F.lag("n").over(line)).where("i > 0")
    return df, report.select("i", "stage", "before", F.col("n").alias("after"), (F.col("before") - F.col("n")).alias("removed"))


# ---------------------------------------------------------------- what a row must be


def _size_of(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    return F.size(column) if kind in ("array", "map") else F.length(F.col(column).cast("string"))


def _rules(df: DataFrame, spec: Mapping[str, Mapping]) -> dict[str, Column]:
    """Rule name -> condition for a schema; a missing column breaks its required rule only."""
    out: dict[str, Column] = {}
    for column, rules in spec.items():
        there = column in df.columns
        if rules.get("required", True):
            out[f"{column}: missing"] = F.col(column).isNotNull() if there else F.lit(False)
        if not there:
            continue
        unless_null = lambda c, column=column: F.col(column).isNull() | c
        if "least_size" in rules:
            out[f"{column}: too short"] = unless_null(_size_of(df, column) >= rules["least_size"])
        if "values" in rules:
            out[f"{column}: not allowed"] = unless_null(F.col(column).isin(*rules["values"]))
        if "between" in rules:
            low, high = rules["between"]
            out[f"{column}: out of range"] = unless_null(F.col(column).between(low, high))
        if "roles" in rules:
            out[f"{column}: unknown role"] = unless_null(F.forall(column, lambda m: F.coalesce(m["role"].isin(*domain.ROLES), F.lit(False))))
            for role in rules["roles"]:
                out[f"{column}: no {role}"] = unless_null(F.array_contains(F.transform(column, lambda m: m["role"]), role))
        if "differs_from" in rules and rules["differs_from"] in df.columns:
            out[f"{column}: same as {rules['differs_from']}"] = unless_null(~F.col(column).eqNullSafe(F.col(rules["differs_from"])))
    return out


_TICKET = {"customer_message": {"least_size": 5}, "agent_response": {"least_size": 5}}
_ANNOTATED = {**_TICKET, "intent": {}, "urgency": {"values": domain.URGENCIES}, "workflow_steps": {"least_size": 1}, "tools_required": {}, "confidence": {"between": (0.0, 1.0)}}
_SCORE = {"between": (1.0, 5.0)}
#: Schema -> column -> rules: required unless said otherwise, and what its values must be.
SCHEMAS: dict[str, dict[str, dict]] = {
    "raw_ticket": _TICKET,
    "annotated_ticket": _ANNOTATED,
    "canonical_ticket": {**_ANNOTATED, "annotation_confidence": {"required": False}, "channel": {"required": False}, "language": {"required": False}},
    "chat": {"messages": {"least_size": 2, "roles": ("user", "assistant")}},
    "preference_pair": {"prompt": {"least_size": 1}, "chosen": {"least_size": 1}, "rejected": {"least_size": 1, "differs_from": "chosen"}},
    "completion": {"prompt": {"least_size": 1}, "completion": {"least_size": 1}, "label": {"values": (True, False)}},
    "tool_call": {"name": {"least_size": 1}},
    "answer": {n: {} for n in ("intent", "urgency", "workflow_steps", "tools_required", "reasoning", "response")},
    "quality_score": {n: _SCORE for n in ("helpfulness", "correctness", "coherence", "verbosity")},
}


def validate_dataset(df: DataFrame, schema: str | Mapping[str, Mapping], key: str, first: int | None = None, raise_on_error: bool = False) -> tuple[DataFrame, DataFrame]:
    """(report, errors) of the rows, or only the first ones by key, against a schema of SCHEMAS or of
    one's own: report is one row (total, valid, invalid, valid_ratio; the ratio is 0 without rows),
    errors has (key, error) for every broken rule.  ``raise_on_error`` raises ValueError with the first error.
    """
    spec = SCHEMAS[schema] if isinstance(schema, str) else schema
    rows = df if first is None else df.orderBy(key).limit(first)
    rules = _rules(df, spec)
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()])) if rules else F.array().cast("array<string>")
    checked = rows.select(key, broken.alias("errors"))
    errors = checked.select(key, F.explode("errors").alias("error"))
    if raise_on_error and (bad := errors.orderBy(key, "error").first()) is not None:
        raise ValueError(f"{key} {bad[0]}: {bad['error']}")
    n, good = F.count(F.lit(1)), F.count_if(F.size("errors") == 0)
    report = checked.agg(n.alias("total"), good.alias("valid"), (n - good).alias("invalid"), F.when(n > 0, good / n).otherwise(0.0).alias("valid_ratio"))
    return report, errors


def validate_rows(df: DataFrame, constraints: dict[str, Column], key: str) -> DataFrame:
    """(key, errors): the names of the constraints that each bad row breaks."""
    broken = F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in constraints.items()])
    return df.select(key, F.filter(broken, lambda x: x.isNotNull()).alias("errors")).where(F.size("errors") > 0)
