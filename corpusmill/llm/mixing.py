"""Mixing sources to target weights by iterative proportional fitting (native).

Token counts by (source, language, topic) cell are raked until the source, language and topic
margins meet their targets; each document is then drawn with its cell's calibrated probability,
or, with a token budget, taken in whole copies and a drawn one for the fraction.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

DIMENSIONS = ("source", "lang", "topic")
NONE = "\u0000none"
#: Cells that one task may rake; above this, coarser dimensions are asked for.
MAX_CELLS = 200_000


def token_estimate(text: Column) -> Column:
    """Tokens of a text, taken as one for every four UTF-8 bytes begun."""
    return F.floor((F.octet_length(F.coalesce(text, F.lit(""))) + F.lit(3)) / F.lit(4)).cast("long")


def coarse_topic(text: Column) -> Column:
    """A topic by the form of the text: table, list, short, long or prose."""
    body = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(body, F.lit(" | ")), "table")
        .when(F.contains(body, F.lit("\n- ")), "list")
        .when(F.octet_length(body) < 400, "short")
        .when(F.octet_length(body) >= 8000, "long")
        .otherwise("prose")
    )


def draw(key: Column, seed: int) -> Column:
    """A uniform number in [0, 1) that only key and seed decide."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _cells(docs: DataFrame, text: str) -> DataFrame:
    name = lambda c: F.coalesce(docs[c].cast("string"), F.lit(NONE))
    return docs.select(
        name("source").alias("source"), name("lang").alias("lang"), coarse_topic(docs[text]).alias("topic"), token_estimate(docs[text]).alias("tokens")
    )


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float] | None], *, alpha: float, rounds: int) -> DataFrame:
    """Cells (dimensions, tokens) with ``factor``, the raked weight for each token.

    A dimension without targets gets its observed shares to the power ``alpha``.  A value
    without a target gets 0.  ``goal_*``: the margins aimed at, ``w``: the tokens reached in weight.  All cells are in
    one partition, so the rounds shuffle nothing.
    """
    cells = cells.coalesce(1)
    whole = Window.partitionBy(F.lit(0))
    for d in DIMENSIONS:
        own = Window.partitionBy(d)
        if targets.get(d):
            goal = F.coalesce(F.element_at(F.create_map(*[x for k, v in sorted(targets[d].items()) for x in (F.lit(k), F.lit(float(v)))]), F.col(d)), F.lit(0.0))
        else:
            goal = F.pow(F.sum("tokens").over(own) / F.sum("tokens").over(whole), F.lit(float(alpha)))
        cells = cells.withColumn(f"g_{d}", goal)
        one = F.when(F.row_number().over(own.orderBy(*DIMENSIONS)) == 1, F.col(f"g_{d}")).otherwise(F.lit(0.0))
        cells = cells.withColumn("one", one).withColumn(f"g_{d}", F.col(f"g_{d}") / F.sum("one").over(whole)).drop("one")
    cells = cells.withColumn("w", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for d in DIMENSIONS:
            held = F.sum("w").over(Window.partitionBy(d))
            cells = cells.withColumn("w", F.when(held > 0, F.col("w") * F.col(f"g_{d}") / held).otherwise(F.lit(0.0)))
    return cells.select(*DIMENSIONS, "tokens", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(F.lit(0.0)).alias("factor"), "w", *[F.col(f"g_{d}").alias(f"goal_{d}") for d in DIMENSIONS])


def margin_error(raked: DataFrame) -> float:
    """The largest difference between a margin reached and its goal, in shares; 0 without cells."""
    worst = 0.0
    whole = raked.agg(F.sum("w")).first()[0]
    for d in DIMENSIONS if whole else ():
        sums = raked.groupBy(d).agg(F.sum("w").alias("s"), F.first(f"goal_{d}").alias("g"))
        worst = max(worst, sums.agg(F.max(F.abs(F.col("s") / F.lit(whole) - F.col("g")))).first()[0] or 0.0)
    return worst


def calibrated(docs: DataFrame, targets: Mapping[str, Mapping[str, float] | None] | None = None, *, alpha: float = 0.9, rounds: int = 8, text: str = "text", budget: float | None = None, tolerance: float = 0.01) -> DataFrame:
    """Cells with ``probability``: the factor over the largest, so that nothing is drawn twice.

    The share of tokens drawn from each source, language and topic then meets its target, and
    the sample is the largest that can do so without repeats: its size hangs on the cell with
    the largest factor alone.  With ``budget`` the factors are scaled so that the tokens expected
    are ``budget`` times those of ``docs``; a probability over 1 then stands for copies.

    Rounds are doubled, up to 8 times as many, until every margin is within ``tolerance`` of its goal.  Targets that can't be met
    together, and a target over 0 for a value that no row has, are an error; shares to the power ``alpha`` that can't be met are
    met as far as they can.
    """
    if budget is not None and not budget > 0:
        raise ValueError("budget: over 0")
    found = materialize(_cells(docs, text).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    n = found.count()
    if n > MAX_CELLS:
        raise ValueError(f"{n} cells of source, language and topic; {MAX_CELLS} at most")
    for d, goals in (targets or {}).items():
        if goals and n:
            there = {r[0] for r in found.where(F.col(d).isin(*goals)).select(d).distinct().collect()}
            if absent := sorted(v for v, share in goals.items() if share > 0 and v not in there):
                raise ValueError(f"no row has the {d} {', '.join(absent)}, which has a target")
    most = 8 * rounds
    while True:
        raked = materialize(rake(found, targets or {}, alpha=alpha, rounds=rounds), "raked")
        error = margin_error(raked)
        if error <= tolerance or 2 * rounds > most:
            break
        rounds *= 2
    if error > tolerance and any((targets or {}).values()):
        raise ValueError(f"the targets can't be met together: a margin is off by {error:.3f} after {rounds} rounds")
    whole = Window.partitionBy(F.lit(0))
    if budget is None:
        top = F.max("factor").over(whole)
    else:
        top = F.sum(F.col("tokens") * F.col("factor")).over(whole) / (F.lit(float(budget)) * F.sum("tokens").over(whole))
    return raked.select(*DIMENSIONS, F.when(top > 0, F.col("factor") / top).otherwise(F.lit(0.0)).alias("probability"))


def mix_sources(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float] | None] | None = None, *, alpha: float = 0.9, rounds: int = 8, seed: int = 7, key: str = "doc_id", text: str = "text", budget: float | None = None
) -> DataFrame:
    """The sampled rows of ``docs``, all its columns, and mix_topic, mix_tokens, mix_probability.

    The key and the seed decide about a row.  Null sources and languages are a value of their
    own; texts without tokens (null or empty) weigh nothing and are kept with probability of
    their cell, or left out where the cell holds no token at all; repeated rows are drawn or
    left together; an empty table stays empty.  Columns of docs that are called mix_* are replaced.
    The table joined is bounded by MAX_CELLS, so it is broadcast.
    With ``budget`` (see ``calibrated``) a row whose probability is over 1 comes as often as its
    whole part says, once more if drawn for the rest; a text without tokens comes once at most.
    """
    docs = docs.drop("mix_topic", "mix_tokens", "mix_probability")
    cells = materialize(calibrated(docs, targets, alpha=alpha, rounds=rounds, text=text, budget=budget), "raked")
    cells = cells.select(*[F.col(d).alias(f"mix_c_{d}") for d in DIMENSIONS], F.col("probability").alias("mix_probability"))
    name = lambda c: F.coalesce(docs[c].cast("string"), F.lit(NONE))
    rows = docs.withColumns({"mix_topic": coarse_topic(docs[text]), "mix_tokens": token_estimate(docs[text]), "mix_k_source": name("source"), "mix_k_lang": name("lang")})
    on = (F.col("mix_k_source") == F.col("mix_c_source")) & (F.col("mix_k_lang") == F.col("mix_c_lang")) & (F.col("mix_topic") == F.col("mix_c_topic"))
    rows = rows.join(F.broadcast(cells), on)
    if budget is None:
        rows = rows.where(draw(F.col(key), seed) < F.col("mix_probability"))
    else:
        whole = F.floor("mix_probability")
        copies = (whole + (draw(F.col(key), seed) < F.col("mix_probability") - whole).cast("long")).cast("int")
        rows = rows.withColumn("mix_copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("mix_tokens") > 0, copies).otherwise(F.least(copies, F.lit(1))))))
    return rows.select(*docs.columns, "mix_topic", "mix_tokens", "mix_probability")


def mixing_sql(alpha: float = 0.9, rounds: int = 8, seed: int = 7) -> str:
    """The same in DuckDB SQL, for observed shares to the power alpha as targets."""
    steps, last = [], "g"
    for r in range(rounds):
        for d in DIMENSIONS:
            steps.append(f"w{r}{d} AS (SELECT * REPLACE (w * g_{d} / sum(w) OVER (PARTITION BY {d}) AS w) FROM {last})")
            last = f"w{r}{d}"
    shares = ", ".join(f"(SELECT sum(v) FROM (SELECT pow(sum(tokens) / (SELECT sum(tokens) FROM c), {alpha}) AS v FROM c GROUP BY {d})) AS t_{d}" for d in DIMENSIONS)
    goals = ", ".join(f"pow(sum(tokens) OVER (PARTITION BY {d}) / sum(tokens) OVER (), {alpha}) / t_{d} AS g_{d}" for d in DIMENSIONS)
    return f"""WITH d AS (SELECT doc_id, coalesce(source, '{NONE[1:]}') AS source, coalesce(lang, '{NONE[1:]}') AS lang,
 CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), chr(10) || '- ') THEN 'list'
 WHEN strlen(coalesce(text, '')) < 400 THEN 'short' WHEN strlen(coalesce(text, '')) >= 8000 THEN 'long' ELSE 'prose' END AS topic,
 CAST((strlen(coalesce(text, '')) + 3) // 4 AS BIGINT) AS tokens FROM documents),
 c AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL),
 t AS (SELECT {shares}), g AS (SELECT source, lang, topic, tokens, tokens AS w, {goals} FROM c, t),
 {", ".join(steps)},
 p AS (SELECT source, lang, topic, (w / tokens) / max(w / tokens) OVER () AS probability FROM {last} WHERE tokens > 0)
SELECT doc_id, topic, tokens, round(probability, 6) AS probability FROM d JOIN p USING (source, lang, topic)
WHERE CAST('0x' || substr(md5('{seed}:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 < probability"""
