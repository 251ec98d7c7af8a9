"""Profiles of a ticket or document corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill import domain
from corpusmill.functions import text as tx
from corpusmill.operators.quality import first_of_each


def histogram(df: DataFrame, column: str, default: str = "unknown") -> DataFrame:
    """(value, n, percent) of a column; nulls are ``default``."""
    counts = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(default)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(counts.agg(F.sum("n").alias("all__"))).select("value", "n", (100.0 * F.col("n") / F.col("all__")).alias("percent"))


def depth(turns: DataFrame, group: str = "conv_id", role: str = "role") -> DataFrame:
    """One row on the number of turns of the conversations and who speaks in them."""
    each = turns.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col(role) == "assistant").alias("agent"), F.bool_or(F.col(role) == "user").alias("user"))
    at = lambda k: F.count_if(F.col("n") >= k).alias(f"at_least_{k}")
    return each.agg(F.count(F.lit(1)).alias("conversations"), F.count_if(F.col("n") == 1).alias("single"), at(2), at(5), at(10), F.max("n").alias("most"), F.avg("n").alias("mean"), F.count_if("agent").alias("with_agent"), F.count_if("user").alias("with_user"))


def ticket_depth(df: DataFrame, replies: str = "conversations") -> DataFrame:
    """One row on the replies of tickets, where a ticket may have none: counts by number, and how
    many have a reply of the agent (``incoming`` is false) or a further one of the customer (true);
    a reply without the mark is neither."""
    n = F.coalesce(F.size(replies), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    marked = lambda v: F.coalesce(F.exists(replies, lambda r: F.coalesce(r["incoming"] == v, F.lit(False))), F.lit(False))
    at = lambda k: F.count_if(n >= k).alias(f"at_least_{k}")
    return df.agg(F.count(F.lit(1)).alias("tickets"), F.count_if(n == 0).alias("none"), F.count_if(n == 1).alias("single"), at(2), at(5), at(10), F.max(n).alias("most"), F.avg(n).alias("mean"), F.count_if(marked(False)).alias("with_agent"), F.count_if(marked(True)).alias("with_follow_up"))


def usable(description: Column, status: Column, spam: Column, replies: Column, least: int = 20) -> dict[str, Column]:
    """What a ticket can train: single_turn (no spam, a description of ``least`` characters,
    resolved or closed), with_response (and the agent's first reply as long), multi_turn (and two replies)."""
    said = F.length(tx.strip(F.coalesce(description, F.lit(""))))
    resolved = ~F.coalesce(spam, F.lit(False)) & (said >= least) & F.coalesce(status.isin(4, 5), F.lit(False))
    agent = F.filter(replies, lambda r: F.coalesce(~r["incoming"], F.lit(False)))
    answer = F.length(tx.strip(F.coalesce(F.try_element_at(agent, F.lit(1))["body_text"], F.lit(""))))
    return {"single_turn": resolved, "with_response": resolved & (F.coalesce(answer, F.lit(0)) >= least), "multi_turn": resolved & (F.coalesce(F.size(replies), F.lit(0)) >= 2)}


def usability(df: DataFrame, description: str = "description_text", status: str = "status", spam: str = "spam", replies: str = "conversations") -> DataFrame:
    """One row: tickets, and how many are usable in each way, or in none."""
    ways = usable(F.col(description), F.col(status), F.col(spam), F.col(replies))
    return df.agg(F.count(F.lit(1)).alias("tickets"), *[F.count_if(c).alias(n) for n, c in ways.items()], F.count_if(~ways["single_turn"]).alias("not_usable"))


def keep_organic(df: DataFrame, languages: Sequence[str], *, key: str, description: str = "description_text", status: str = "status", spam: str = "spam", replies: str = "conversations", language: str = "detected_language", subject: str = "subject", email: str = "support_email", sentiment: str = "sentiment_score") -> DataFrame:
    """Tickets fit for training: resolved or closed, with a reply of the agent, over 20 characters,
    in one of ``languages``, no spam and not automatic; of equal descriptions the first by key."""
    agent = F.coalesce(F.exists(replies, lambda r: F.coalesce(~r["incoming"], F.lit(False))), F.lit(False))
    long = F.length(tx.strip(F.coalesce(F.col(description), F.lit("")))) > 20
    n = F.greatest(F.coalesce(F.size(replies), F.lit(0)), F.lit(0))
    auto = is_automated(F.col(description), F.col(subject), F.col(email), n, F.col(sentiment))
    kept = df.where(F.coalesce(F.col(status).isin(4, 5), F.lit(False)) & agent & long & F.coalesce(F.col(language).isin(*languages), F.lit(False)) & ~F.coalesce(F.col(spam), F.lit(False)) & ~auto)
    return first_of_each(kept, F.md5(description), key)


def length_stats(df: DataFrame, column: str) -> DataFrame:
    """Lengths of the texts with five characters or more when stripped, in buckets; the median is
    the upper one."""
    n = F.length(column)
    used = df.where(F.length(tx.strip(F.col(column))) >= 5).select(n.alias("n"))
    sums = used.agg(
        F.count(F.lit(1)).alias("texts"), F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"), F.count_if(F.col("n") < 50).alias("under_50"),
        F.count_if((F.col("n") >= 50) & (F.col("n") < 500)).alias("under_500"), F.count_if((F.col("n") >= 500) & (F.col("n") < 2000)).alias("under_2000"), F.count_if(F.col("n") >= 2000).alias("longer"),
    )
    return sums.crossJoin(upper_median(used, "n"))


def upper_median(df: DataFrame, column: str, width: int = 1024) -> DataFrame:
    """One row, ``median``: the element at ``floor(n / 2)`` of the ordered non-null integers (null without any).

    Values are counted, and the counts by ranges of ``width`` values say which range holds it, so
    that only its at most ``width`` counts are ordered.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c")).withColumn("b", F.floor(F.col("v") / width))
    upto = lambda by: F.sum("c").over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    ranges = counts.groupBy("b").agg(F.sum("c").alias("c")).withColumn("upto", upto("b"))
    place = counts.agg(F.floor(F.sum("c") / 2).alias("place"))
    at = ranges.crossJoin(place).where((F.col("upto") > F.col("place")) & (F.col("upto") - F.col("c") <= F.col("place"))).select(F.col("b").alias("at"), (F.col("place") - F.col("upto") + F.col("c")).alias("rest"))
    inside = counts.join(at, F.col("b") == F.col("at")).withColumn("upto", upto("v"))
    return inside.where("upto > rest").agg(F.min("v").alias("median"))


def time_profile(df: DataFrame, column: str) -> DataFrame:
    """(unit, value, n) by month, weekday and hour; times that can't be read are skipped."""
    t = F.col(column).try_cast("timestamp")
    units = F.array(*[F.struct(F.lit(u).alias("unit"), v.alias("value")) for u, v in (("month", F.date_format(t, "yyyy-MM")), ("weekday", F.date_format(t, "EEEE")), ("hour", F.hour(t).cast("string")))])
    hours = df.where(t.isNotNull()).groupBy(F.date_trunc("hour", t).alias(column)).agg(F.count(F.lit(1)).alias("c"))
    return hours.select(F.explode(units).alias("u"), "c").groupBy("u.unit", "u.value").agg(F.sum("c").alias("n"))


def tag_profile(df: DataFrame, column: str) -> DataFrame:
    """One row: rows with a tag, rows without (null or empty lists), and distinct tags."""
    n = F.coalesce(F.size(column), F.lit(0))
    sums = df.agg(F.count_if(n > 0).alias("with_tags"), F.count_if(n <= 0).alias("without_tags"))
    return sums.crossJoin(df.select(F.explode(column).alias("t")).agg(F.countDistinct("t").alias("distinct_tags")))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties by value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)


def top_tags(df: DataFrame, column: str, k: int = 50) -> DataFrame:
    return top_values(df.select(F.explode(column).alias("tag")), "tag", k)


def subject_profile(df: DataFrame, column: str) -> DataFrame:
    """Distinct subjects by their first 50 characters (lower case, stripped), and those repeated."""
    groups = df.groupBy(F.substring(F.lower(tx.strip(F.col(column))), 1, 50).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(column)).alias("l"))
    return groups.agg(F.count(F.lit(1)).alias("distinct_subjects"), (F.sum("l") / F.sum("n")).alias("mean_length"), F.count_if(F.col("n") >= 5).alias("repeated_5_plus"))


def top_subjects(df: DataFrame, column: str, k: int = 30) -> DataFrame:
    """The k most frequent subjects by their first 50 characters (lower case, stripped)."""
    return top_values(df.select(F.substring(F.lower(tx.strip(F.col(column))), 1, 50).alias("s")), "s", k)


def value_buckets(df: DataFrame, column: str, edges: Sequence[tuple[float, float]] = ((0, 20), (21, 40), (41, 60), (61, 80), (81, 100))) -> DataFrame:
    """Mean, least, most and inclusive buckets of a column's non-null values."""
    return df.where(F.col(column).isNotNull()).agg(F.avg(column).alias("mean"), F.min(column).alias("least"), F.max(column).alias("most"), *[F.count_if(F.col(column).between(a, b)).alias(f"from_{a}_to_{b}") for a, b in edges])


def is_automated(description, subject, email, replies, sentiment):
    """Whether a ticket looks automatic, by phrases, sender, neutral silence or placeholder subject."""
    return (
        tx.any_of(F.coalesce(description, F.lit("")), domain.AUTOMATED_PHRASES)
        | tx.any_of(F.coalesce(email, F.lit("")), ("noreply",))
        | ((replies == 0) & (F.coalesce(sentiment, F.lit(50)) == 50))
        | (tx.strip(F.lower(F.coalesce(subject, F.lit("")))) == "[name]")
    )


def field_fill(df: DataFrame, column: str) -> DataFrame:
    """(field, present, filled) of a map column."""
    return df.select(F.explode(column).alias("field", "v")).groupBy("field").agg(F.count(F.lit(1)).alias("present"), F.count_if(tx.strip(F.coalesce(F.col("v").cast("string"), F.lit(""))) != "").alias("filled"))


def annotation_summary(df: DataFrame, intent: str = "intent", urgency: str = "urgency", confidence: str = "confidence") -> DataFrame:
    """(part, value, n, percent, mean_confidence, least_confidence) of annotated rows: a line for
    every intent and urgency, and one for all rows (part "all")."""
    n = F.count(F.lit(1))
    counts = df.groupBy(intent, urgency).agg(n.alias("n"), F.sum(confidence).alias("s"), F.count(confidence).alias("c"), F.min(confidence).alias("low"))
    line = lambda part, value: F.struct(F.lit(part).alias("part"), value.cast("string").alias("value"))
    lines = counts.select(F.explode(F.array(line("intent", F.col(intent)), line("urgency", F.col(urgency)), line("all", F.lit(None)))).alias("l"), "n", "s", "c", "low")
    sums = lines.groupBy("l.part", "l.value").agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("c")).alias("mean_confidence"), F.min("low").alias("least_confidence"))
    whole = counts.agg(F.sum("n").alias("all__"))
    return sums.crossJoin(whole).select("part", "value", "n", (100.0 * F.col("n") / F.col("all__")).alias("percent"), "mean_confidence", "least_confidence")


def chat_statistics(df: DataFrame, messages: str = "messages", split: str | None = None) -> DataFrame:
    """Rows and the mean, least and most characters of all their messages, for each split if one is named."""
    size = F.aggregate(messages, F.lit(0).cast("long"), lambda s, m: s + F.coalesce(F.length(m["content"]), F.lit(0)))
    rows = df.select(*([split] if split else []), size.alias("n"))
    stats = [F.count(F.lit(1)).alias("chats"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most")]
    return rows.groupBy(split).agg(*stats) if split else rows.agg(*stats)


def metadata(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_examples")).select(F.lit(name).alias("name"), "num_examples", F.array(*map(F.lit, df.columns)).alias("columns"))
