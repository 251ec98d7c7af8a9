"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Benchmark items are partitioned by their number of distinct five-word shingles.  For items of
S/2 to S shingles, documents are cut into blocks of S shingles, so that an item inside a long
document is not lost among its other words; each block's minimum under every hash function is
looked up among the items' minima.  With containment t, one function finds an item of q shingles
with probability of t*q/(q+S) at least, whatever the document's length; each partition takes as many functions
as leave a miss of MISS at most.  Items of up to TINY shingles are looked up by all of theirs.
What is found is then verified by exact containment in the whole document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, distinct_sorted, mix, text_parts

TINY = 8
MISS = 1e-6
#: Items that one block sends to the executors, on average, and UTF-8 bytes of their texts.
BLOCK_ITEMS, BLOCK_BYTES = 50_000, 16 << 20


class Keys:
    """Sorted 64-bit keys with the items that have each."""

    def __init__(self, keys: np.ndarray, items: np.ndarray):
        order = np.lexsort((items, keys))
        self.keys, self.items = keys[order], items[order]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.keys >> np.uint64(48)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index in values, item) of every match."""
        at = np.flatnonzero(self.seen[values >> np.uint64(48)])
        lo, hi = (np.searchsorted(self.keys, values[at], side=s) for s in ("left", "right"))
        n = hi - lo
        flat = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else lo
        return np.repeat(at, n), self.items[flat]


class ItemIndex:
    """The items of one block: their shingle sets and the keys of each size partition."""

    def __init__(self, ids: list, texts: list, threshold: float):
        self.ids, self.threshold = ids, threshold
        self.sets = distinct_sorted(*Words(pa.array(texts, pa.string())).shingles())
        sizes = np.array([len(s) for s in self.sets], np.int64)
        tiny = np.flatnonzero((sizes > 0) & (sizes <= TINY))
        self.tiny = Keys(np.concatenate([self.sets[i] for i in tiny]), np.repeat(tiny, sizes[tiny])) if len(tiny) else None
        self.classes = []
        block = 2 * TINY
        while (sizes > block // 2).any():
            held = np.flatnonzero((sizes > block // 2) & (sizes <= block))
            if len(held):
                q = block // 2 + 1
                functions = math.ceil(math.log(MISS) / math.log(1 - threshold * q / (q + block)))
                self.classes.append((block, [Keys(np.array([(self.sets[i] * a).min() for i in held]), held) for a in factors(functions)]))
            block *= 2

    def candidates(self, first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Distinct (text, item) rows that share a minimum."""
        found = []
        n = np.diff(first)
        if self.tiny is not None and len(hashes):
            at, item = self.tiny.find(hashes)
            found.append((np.searchsorted(first, at, side="right") - 1, item))
        for block, functions in self.classes if len(hashes) else ():
            blocks = -(-n // block)
            owner = np.repeat(np.arange(len(n)), blocks)
            starts = first[:-1][owner] + block * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
            for a, keys in zip(factors(len(functions)), functions):
                at, item = keys.find(np.minimum.reduceat(hashes * a, starts))
                found.append((owner[at], item))
        if not found:
            return np.empty((0, 2), np.int64)
        pairs = np.unique(np.concatenate([t for t, _ in found]) * len(self.ids) + np.concatenate([i for _, i in found]))
        return np.stack((pairs // len(self.ids), pairs % len(self.ids)), axis=1)

    def matches(self, array) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) of each verified containment."""
        first, hashes = Words(array).shingles()
        out, last, held = [], -1, None
        for t, i in self.candidates(first, hashes).tolist():
            if t != last:
                held, last = np.unique(hashes[first[t] : first[t + 1]]), t
            item = self.sets[i]
            at = np.minimum(np.searchsorted(held, item), len(held) - 1)
            shared = int((held[at] == item).sum())
            if shared >= math.ceil(round(self.threshold * len(item), 9)):
                out.append((t, i, shared))
        return out


def factors(n: int) -> np.ndarray:
    """Odd factors that permute the 64-bit shingle hashes."""
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def item_blocks(items: DataFrame, key: str, text: str):
    """The items in parts of a bounded size, for the driver to send one after the other."""
    size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    n = max(1, math.ceil((size[0] or 0) / BLOCK_ITEMS), math.ceil((size[1] or 0) / BLOCK_BYTES))
    rows = items.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    for i in range(n):
        yield sorted(((r["k"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == i).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_contained(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row for each document and item with ``threshold`` or more of the item's distinct
    shingles in the document: key, item_key, n_shingles (the item's), n_shared, containment.

    An item with one to four words has its whole sequence as its one shingle, which only a text
    of the same words holds; items and texts without words, or null, match nothing.  Null keys
    are kept as nulls, repeated rows give repeated results, empty tables no rows; other columns
    are ignored.  Large benchmarks go over the documents block by block.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    schema = f"`{key}` {kind}, `{item_key}` bigint, n_shingles int, n_shared int, containment double"
    out = None
    for rows in item_blocks(items, item_key, item_text):
        index = spark.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows], threshold))

        def run(batches, index=index):
            for part in text_parts(batches, "t"):
                m = index.value.matches(part.column("t"))
                size = [len(index.value.sets[i]) for _, i, _ in m]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("k").take(pa.array([t for t, _, _ in m], pa.int64())),
                        pa.array([index.value.ids[i] for _, i, _ in m], pa.int64()),
                        pa.array(size, pa.int32()),
                        pa.array([s for _, _, s in m], pa.int32()),
                        pa.array([s / q for (_, _, s), q in zip(m, size)], pa.float64()),
                    ],
                    names=[key, item_key, "n_shingles", "n_shared", "containment"],
                )

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text: str = "text", item_text: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    at = docs.columns.index(text)
    for rows in item_blocks(items, items.columns[0], item_text):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows], threshold))

        def run(batches, index=index):
            for part in text_parts(batches, docs_text):
                keep = np.ones(part.num_rows, bool)
                keep[[t for t, _, _ in index.value.matches(part.column(at))]] = False
                yield part.filter(pa.array(keep))

        docs_text = text
        docs = docs.mapInArrow(run, docs.schema)
    return docs


def containment_sql(threshold_percent: int = 80) -> str:
    """The same by brute force in DuckDB SQL."""
    words = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    sets = lambda table, key: (
        f"(SELECT DISTINCT {key}, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS s FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (SELECT {key}, {words} AS w FROM {table}) WHERE len(w) > 0))"
    )
    return f"""WITH d AS {sets("documents", "doc_id")}, b AS {sets("benchmark", "item_id")},
 n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
 m AS (SELECT doc_id, item_id, count(*) AS c FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_shingles, CAST(c AS INTEGER) AS n_shared, c / n AS containment FROM m JOIN n USING (item_id) WHERE 100 * c >= {threshold_percent} * n"""
