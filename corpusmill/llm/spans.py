"""Substring dedup by sliding sentence spans.

A sentence ends at a word that ends in ``.``, ``!`` or ``?``, at a line end and at the text's
end.  ``dedup_runs`` takes every run of ``sentences`` consecutive ones as a span, of any length, and a
text with fewer as one span whole; what would be a sentence of fewer than ``least`` words
(an abbreviation, a number, a list mark) runs on into the next, and a sentence of more than ``clause`` words ends at
commas, colons and semicolons too, so that no word is without a span.  ``dedup_spans`` is the general
form, which can also ask a span for words.  The first document that holds a span keeps it; everywhere else, and from
its second place in the same document on, its sentences go.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, broadcast_if_small, materialize, range_hashes, text_parts

_ENDS, _CLAUSES = np.zeros(256, bool), np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_CLAUSES[[ord(c) for c in ",;:"]] = True
#: Extra copies of a row that one task writes.
COPIES = 100_000


@dataclass(frozen=True)
class Size:
    """What a span is: ``sentences`` consecutive ones with ``words`` words, or any number with
    ``long_words``; ``least`` and ``clause`` bound sentences, ``whole`` takes short texts whole."""

    sentences: int = 2
    words: int = 0
    long_words: int | None = None
    least: int = 1
    clause: int | None = None
    whole: bool = False


#: The spans of ``dedup_runs``.
RUNS = Size(sentences=2, least=8, clause=16, whole=True)


class Sentences:
    """Sentences of a batch of texts and the spans over them."""

    def __init__(self, array, size: Size):
        w = self.words = Words(array)
        n = len(w.start)
        lines = np.concatenate(([0], np.cumsum(w.low == 10)))
        stop = np.zeros(n, bool)
        stop[w.first[1:][np.diff(w.first) > 0] - 1] = True
        last = stop.copy()
        if n:
            follow = np.concatenate((w.start[1:], [len(w.low)]))
            last |= _ENDS[w.low[w.end - 1]] | (lines[follow] > lines[w.end])
        to = np.flatnonzero(last) + 1
        if size.clause is not None and len(to):
            length = np.diff(to, prepend=0)
            last |= np.repeat(length > size.clause, length) & _CLAUSES[w.low[w.end - 1]]
            to = np.flatnonzero(last) + 1
        if size.least > 1 and len(to):
            kept, held = [], 0
            for i, (length, ends) in enumerate(zip(np.diff(to, prepend=0).tolist(), stop[to - 1].tolist())):
                held += length
                if held >= size.least or ends:
                    kept.append(i)
                    held = 0
            to = to[kept]
        self.to = to
        self.frm = np.concatenate(([0], self.to[:-1])) if len(self.to) else self.to
        self.first = np.searchsorted(self.to, w.first, side="right")
        self.first[0] = 0
        k = len(self.to)
        text = np.repeat(np.arange(len(w.first) - 1), np.diff(self.first))
        lo, hi = self.first[:-1][text], self.first[1:][text] - 1
        i = np.arange(k)
        ahead = lambda m: np.searchsorted(self.to, self.frm + m)
        back = lambda m: np.searchsorted(self.frm, self.to - m, side="right") - 1
        forward, backward = i + size.sentences - 1, i - size.sentences + 1
        if size.words:
            forward, backward = np.maximum(forward, ahead(size.words)), np.minimum(backward, back(size.words))
        if size.long_words is not None:
            forward, backward = np.minimum(forward, ahead(size.long_words)), np.maximum(backward, back(size.long_words))
        if size.words:
            backward = np.where(self.to < size.words, -1, backward)
        if size.whole:
            forward = np.where((hi - lo + 1 < size.sentences) & (i == lo), hi, forward)
        f, b = forward <= hi, backward >= lo
        pair = np.unique(np.concatenate((i[f] * k + forward[f], backward[b] * k + i[b]))) if k else np.empty(0, np.int64)
        self.a, self.b = (pair // k, pair % k) if k else (pair, pair)
        self.text = text[self.a] if k else pair
        self.hash = range_hashes(w.hash, self.frm[self.a], self.to[self.b]).view(np.int64)


def _unique_pairs(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, index of the first) of each distinct pair."""
    order = np.lexsort((np.arange(len(text)), hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return t[new], h[new], order[new]


SCHEMA = "text string, n_sentences int, n_removed int, words_removed int, removed_spans array<struct<start:int,end:int>>"


def dedup_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", sentences: int = 2, words: int = 12, long_words: int = 40) -> DataFrame:
    """One row per row of ``docs``: key, text (without the sentences removed), n_sentences,
    n_removed, words_removed and removed_spans (character of the first removed sentence's start
    and end, for each run of removed sentences, counted in UTF-8 bytes of the text).

    ``key`` is an integer.  A null text gives null and no sentences; texts without a span stay
    as they are.  Rows with one key are one document, whose rows don't remove each other's
    spans.  Rows with a null key lose only their own repeats.  An empty table gives no rows;
    other columns are ignored.
    """
    size = Size(sentences, words, long_words)
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return _without_later(source.where("k IS NOT NULL"), size, key).unionAll(_cut_all(source.where("k IS NULL"), size, key))


def dedup_runs(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: Size = RUNS) -> DataFrame:
    """The same over every run of consecutive sentences (see RUNS), where every row is a document.

    Documents come in order of key, null keys last, then of a hash of their text; the first that
    holds a span keeps it, and of rows equal in key and text one is the first.  All the others lose every
    sentence, so an exact copy is left without text, whatever its length.  A null text gives null and no
    sentences, one without words stays as it is.  Texts of any length are read whole.  An empty table
    gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    mark = F.xxhash64("t").bitwiseXOR(F.when(F.col("k").isNull(), F.lit(0x5851F42D4C957F2D)).otherwise(F.lit(0).cast("long")))
    marked = source.where("t IS NOT NULL").withColumn("r", mark)
    held = materialize(marked.groupBy("k", "r").agg(F.count(F.lit(1)).alias("n")), "row_marks")
    none = _cut_all(source.where("t IS NULL"), size, key)
    if not held.groupBy("k").agg(F.sum("n").alias("n")).where("n > 1").limit(1).count():
        with_null = marked.where("k IS NULL").limit(1).count() > 0
        return _without_later(marked if with_null else marked.drop("r"), size, key).unionAll(none)
    repeated = held.where("n > 1")
    if not repeated.limit(1).count():
        return _without_later(marked, size, key).unionAll(none)
    rep = broadcast_if_small(repeated.select(F.col("k").alias("k2"), F.col("r").alias("r2"), "n"))
    same = F.col("k").eqNullSafe(F.col("k2")) & (F.col("r") == F.col("r2"))
    once = materialize(marked.join(rep, same).groupBy("k", "r").agg(F.min("t").alias("t"), F.max("n").alias("n")), "rows_once")
    single = marked.join(rep, same, "left_anti").unionByName(once.select("k", "t", "r"))
    parts = once.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 2) / COPIES)))).repartition("k", "r", "part")
    extra = parts.withColumn("copy", F.explode(F.sequence(F.col("part") * COPIES, F.least((F.col("part") + 1) * COPIES, F.col("n") - 1) - 1)))
    return _without_later(single, size, key).unionAll(_cut_all(extra.select("k", "t"), size, key, everything=True)).unionAll(none)


def _without_later(source: DataFrame, size: Size, key: str) -> DataFrame:
    """The rows of (k, t), each k a document, or of (k, t, r), each (k, r) one, without the spans
    that a document before it holds."""
    ids = ["k", "r"] if "r" in source.columns else ["k"]
    if "r" in ids:  # null keys last, apart by their marks
        source = source.select(F.coalesce("k", F.lit((1 << 63) - 1)).alias("k"), "t", "r", F.col("k").isNull().alias("none"))

    def emit(batches):
        for part in text_parts(batches, "t"):
            s = Sentences(part.column("t"), size)
            t, h, _ = _unique_pairs(s.text, s.hash)
            at = pa.array(t)
            yield pa.RecordBatch.from_arrays([pa.array(h), *[part.column(c).take(at) for c in ids]], names=["h", *ids])

    held = source.where("t IS NOT NULL").select(*ids, "t").mapInArrow(emit, "h bigint, " + ", ".join(f"{c} bigint" for c in ids))
    who = F.struct(*ids) if len(ids) > 1 else F.col("k")
    shared = held.groupBy("h").agg(F.min(who).alias("first"), F.max(who).alias("last")).where("first <> last").select("h", "first")
    shared = materialize(shared, "shared_spans")
    later = materialize(held.join(shared, "h").where(who != F.col("first")).select("h", *ids), "later_spans")
    lists = later.groupBy(*ids).agg(F.collect_list("h").alias("gone")).withColumnsRenamed({c: f"{c}2" for c in ids})
    on = F.col("k") == F.col("k2")
    return _cut_all(source.join(lists, on & (F.col("r") == F.col("r2")) if len(ids) > 1 else on, "left"), size, key)


def _cut_all(rows: DataFrame, size: Size, key: str, everything: bool = False) -> DataFrame:
    """Rows (k, t, gone) without the spans in ``gone`` (none, if it isn't there) and their own repeats, or without any sentence."""
    own = F.when(~F.col("none"), F.col("k")) if "none" in rows.columns else F.col("k")
    gone = F.col("gone") if "gone" in rows.columns else F.lit(None).cast("array<long>")

    def cut(batches):
        for part in text_parts(batches, "t"):
            yield _cut(part, key, size, everything)

    return rows.select(own.alias("k"), "t", gone.alias("gone")).mapInArrow(cut, f"`{key}` bigint, {SCHEMA}")


def _cut(part: pa.RecordBatch, key: str, size: Size, everything: bool = False) -> pa.RecordBatch:
    s = Sentences(part.column("t"), size)
    w = s.words
    drop = np.zeros(len(s.to) + 1, np.int64)
    _, _, first = _unique_pairs(s.text, s.hash)
    again = np.ones(len(s.hash), bool)
    again[first] = False
    gone = part.column("gone")
    lists = gone.flatten().to_numpy(zero_copy_only=False) if len(gone) else np.empty(0, np.int64)
    count = np.array([len(x) if x is not None else 0 for x in gone.to_pylist()], np.int64) if gone.null_count < len(gone) else np.zeros(len(gone), np.int64)
    owner = np.repeat(np.arange(len(gone)), count)
    if len(lists):
        both_t, both_h = np.concatenate((owner, s.text)), np.concatenate((lists, s.hash))
        order = np.lexsort((np.arange(len(both_t)), both_h, both_t))
        bt, bh = both_t[order], both_h[order]
        run = np.cumsum(np.concatenate(([True], (bt[1:] != bt[:-1]) | (bh[1:] != bh[:-1])))) - 1
        listed = np.zeros(run[-1] + 1, bool)
        listed[run[order < len(lists)]] = True
        mine = order >= len(lists)
        again[order[mine] - len(lists)] |= listed[run[mine]]
    np.add.at(drop, s.a[again], 1)
    np.add.at(drop, s.b[again] + 1, -1)
    out = (np.cumsum(drop)[:-1] > 0) | everything
    raw = [None if x is None else x.encode() for x in part.column("t").to_pylist()]
    texts, removed, lost, ranges = [], [], [], []
    for i, body in enumerate(raw):
        a, b = s.first[i], s.first[i + 1]
        mask = out[a:b]
        if body is None or not mask.any():
            texts.append(body)
            removed.append(0)
            lost.append(0)
            ranges.append([])
            continue
        base = w.offsets[i]
        begin = w.start[s.frm[a:b]] - base
        stop = np.concatenate((begin[1:], [len(body)]))
        edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
        ranges.append([{"start": int(begin[x]), "end": int(stop[y - 1])} for x, y in zip(edge[::2], edge[1::2])])
        kept, at = [], 0
        for r in ranges[-1]:
            kept.append(body[at : r["start"]])
            at = r["end"]
        texts.append(b"".join([*kept, body[at:]]))
        removed.append(int(mask.sum()))
        lost.append(int((s.to[a:b] - s.frm[a:b])[mask].sum()))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [part.column("k"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.diff(s.first), pa.int32()), pa.array(removed, pa.int32()), pa.array(lost, pa.int32()), pa.array(ranges, kind)],
        names=[key, "text", "n_sentences", "n_removed", "words_removed", "removed_spans"],
    )
