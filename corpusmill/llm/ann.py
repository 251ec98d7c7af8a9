"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors.  Each vector is represented by its ``PREFIX``
nearest pivots in order, and posted in the inverted files of the first ``posts`` of them.  A query goes to
the files of its own nearest pivots only and ranks what they hold by the footrule distance of the two orders (a
pivot missing in the query's counts as place ``asked``); the best ``share`` is reranked by exact distance.
A vector met in several files counts in the first that it is posted in.  The files are a shuffle by
pivot, with crowded ones in parts; vectors are read once to count them and once to post them, whatever
the number of queries, and no query comes to the driver.

The number of pivots grows with the square root of the rows (up to PIVOTS), and the files asked with the
square root of the pivots, so that what a query visits grows slower than the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pivots at most, and places of a vector's order.
PIVOTS, PREFIX = 4096, 16
#: Vectors of one part of a file, on average at most; vectors and queries compared at a time; queries that one task holds for a part.
CROWD, CHUNK, BLOCK, QUERIES = 65_536, 4096, 1024, 20_000
#: Lengths of vectors that one table may mix.
LENGTHS = 64


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, lambda x: ~bad(x)) & F.exists(vector, lambda x: x != 0)


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first (ties: the smaller index)."""
    d = (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    if prefix < d.shape[1]:
        near = np.sort(np.argpartition(d, prefix - 1, axis=1)[:, :prefix], axis=1)
        d = np.take_along_axis(d, near, axis=1)
    else:
        near = np.broadcast_to(np.arange(d.shape[1]), d.shape)
    return np.take_along_axis(near, np.argsort(d, axis=1, kind="stable"), axis=1)


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the points, each the farthest from those before it, so that a crowd gives few."""
    if len(points) <= n:
        return points
    chosen, far = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def matrix(array, n: int) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def mixed(ids: np.ndarray, parts: int) -> np.ndarray:
    """A part for each id, by a hash."""
    x = (ids.astype(np.uint64) ^ (ids.astype(np.uint64) >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(33)) % np.asarray(parts, np.uint64)).astype(np.int64)


class Asked:
    """Queries that came to one part of one file: ids, vectors and places of all pivots (``asked``: none)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, orders: np.ndarray, pivots: int):
        self.ids, self.vectors, self.n = ids, vectors, orders.shape[1]
        self.place = np.full((len(ids), pivots), self.n, np.int16)
        np.put_along_axis(self.place, orders.astype(np.int64), np.arange(self.n, dtype=np.int16)[None, :], axis=1)


class Held:
    """Members of one file that came together; equal vectors are one with all their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, orders: np.ndarray, nth: np.ndarray):
        vectors = vectors + 0.0  # -0.0 equals 0.0
        _, first, index = np.unique(np.ascontiguousarray(vectors).view(f"V{vectors.dtype.itemsize * vectors.shape[1]}").ravel(), return_index=True, return_inverse=True)
        by = np.lexsort((ids, index.ravel()))
        self.ids, self.owned = ids[by], np.searchsorted(index.ravel()[by], np.arange(len(first) + 1))
        self.vectors, self.orders, self.nth = vectors[first], orders[first].astype(np.int64), nth[first]
        self.squares = (self.vectors**2).sum(axis=1)

    def search(self, asked: Asked, block: slice, k: int, share: float):
        """For each query of the block (its place, ids, distances, members visited)."""
        place = asked.place[block]
        total, seen = np.zeros((len(place), len(self.vectors)), np.int32), np.zeros((len(place), len(self.vectors)), bool)
        for i in range(self.orders.shape[1]):
            there = place[:, self.orders[:, i]]
            total += np.abs(there.astype(np.int32) - i)
            if i < self.nth.max(initial=0):  # met in an earlier file of its own
                seen |= (there < asked.n) & (i < self.nth)[None, :]
        copies = np.diff(self.owned)
        points = asked.vectors[block]
        far = self.squares[None, :] - 2 * points @ self.vectors.T + (points**2).sum(axis=1)[:, None]
        for q in range(len(place)):
            mine = np.flatnonzero(~seen[q])
            if not len(mine):
                continue
            take = max(8 * k + 1, math.ceil(share * len(mine)))
            best = mine if take >= len(mine) else mine[np.argpartition(total[q, mine], take - 1)[:take]]
            own = asked.ids[block][q]
            near = best if len(best) <= k + 1 else best[far[q, best] <= np.partition(far[q, best], k)[k] * (1 + 1e-9) + 1e-9]
            # of equal vectors, the k + 1 smallest ids are all that can be among the k nearest
            ids = [self.ids[self.owned[m] : min(self.owned[m + 1], self.owned[m] + k + 1)] for m in near]
            d = np.repeat(np.sqrt(((self.vectors[near] - points[q]) ** 2).sum(axis=1)), [len(x) for x in ids])
            ids = np.concatenate(ids)
            d, ids = d[ids != own], ids[ids != own]
            order = np.lexsort((ids, d))[:k]
            yield block.start + q, ids[order], d[order], int(copies[mine].sum())


def nearest(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, pivots: int | None = None, posts: int = 4, asked: int | None = None, share: float = 0.7, queries: DataFrame | None = None
) -> DataFrame:
    """The ``k`` nearest found of each query, by Euclidean distance in double precision: query_id, rank,
    vec_id, score, visited (rows that the query's files held).

    Queries: the rows whose key is divisible by ``every``, or the rows of ``queries`` (same
    columns); a row never finds its own key.  Fewer than k candidates give fewer rows; ties go to the smaller key.
    Vectors that are null, zero or hold null or non-finite components and rows with null keys
    take no part.  Vectors of different lengths are apart, each length with its own index; over LENGTHS
    of them are an error.  Of repeated keys, queries take one row (the smallest
    vector) and results one (the nearest).  Empty tables give no rows; other columns are ignored.
    Without ``pivots`` there are about four times the square root of the rows; without ``asked``
    a query goes to four times the square root of the pivots' files.  Of four times as many vectors (by a hash
    of the key) those farthest apart are pivots; these and the files' sizes are all that is gathered.
    """
    spark = vectors.sparkSession
    good = lambda df: df.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v")).where(F.col("k").isNotNull() & usable(F.col("v")))
    rows = good(vectors)
    wanted = good(queries) if queries is not None else rows.where(F.pmod("k", F.lit(every)) == 0)
    wanted = wanted.groupBy("k", F.size("v").alias("size")).agg(F.min("v").alias("v")).select("k", "v")
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy("size").limit(LENGTHS + 1).collect()
    if len(sizes) > LENGTHS:
        raise ValueError(f"vectors of over {LENGTHS} lengths")
    found = None
    for r in sizes:
        same = F.size("v") == r["size"]
        part = _search(rows.where(same), wanted.where(same), r["n"], k, pivots, posts, asked, share)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, visited long")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"), F.sum("n").alias("n"))
    own = Window.partitionBy("query_id")
    ranked = once.withColumns({"rank": F.row_number().over(own.orderBy("score", "vec_id")), "visited": F.sum("n").over(own)})
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "visited")


def _search(rows: DataFrame, wanted: DataFrame, n: int, k: int, pivots: int | None, posts: int, asked: int | None, share: float) -> DataFrame:
    """(query_id, vec_id, score, n) of each query in each part of its files; n: what it visited there, in one of its rows."""
    spark = rows.sparkSession
    size = pivots or min(PIVOTS, max(16, 1 << round(math.log2(4 * math.sqrt(n)))))
    sample = rows.orderBy(F.xxhash64("k"), "k", "v").limit(4 * size).collect()  # copies may be among them
    chosen = spread(np.array(list(dict.fromkeys(tuple(r["v"]) for r in sample))), size)
    size, dim = chosen.shape
    posts, prefix = min(posts, size), min(PREFIX, size)
    asked = min(size, asked or math.ceil(4 * math.sqrt(size)))
    sent = spark.sparkContext.broadcast(chosen)

    def count(batches):
        held = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                held += np.bincount(orders(matrix(batch.column("v"), batch.num_rows), sent.value, posts).ravel(), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["f", "n"])

    held = np.zeros(size, np.int64)
    for r in rows.mapInArrow(count, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():
        held[r["f"]] = r["n"]
    parts = spark.sparkContext.broadcast(np.maximum(1, -(-held // CROWD)))
    sides = max(1, math.ceil(wanted.count() * asked / size / QUERIES))
    names = ["f", "s", "side", "kind", "id", "nth", "v", "o"]
    schema = "f int, s int, side int, kind int, id long, nth int, v binary, o binary"

    def batch(f, s, side, kind, ids, nth, v, o):
        ints = [pa.array(np.broadcast_to(x, len(ids)).astype(np.int32)) for x in (f, s, side, kind)]
        return pa.RecordBatch.from_arrays([*ints, pa.array(ids), pa.array(np.broadcast_to(nth, len(ids)).astype(np.int32)), v, o], names=names)

    def binary(values: np.ndarray) -> pa.Array:
        values = np.ascontiguousarray(values)
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(values.dtype.itemsize * values.shape[1]), len(values), [None, pa.py_buffer(values)]).cast(pa.binary())

    def post(batches):
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                piece = b.slice(at, CHUNK)
                ids, v = piece.column("k").to_numpy(), matrix(piece.column("v"), piece.num_rows)
                o = orders(v, sent.value, prefix)
                raw, order = binary(v), binary(o.astype("<i2"))
                for nth in range(posts):
                    for side in range(sides):
                        yield batch(o[:, nth], mixed(ids, parts.value[o[:, nth]]), side, 1, ids, nth, raw, order)

    def ask(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                piece = b.slice(at, 256)
                ids, v = piece.column("k").to_numpy(), matrix(piece.column("v"), piece.num_rows)
                o = orders(v, sent.value, asked)
                raw, order, side = binary(v), binary(o.astype("<i2")), mixed(ids, sides)
                for i in range(asked):
                    times = parts.value[o[:, i]]
                    at_row = np.repeat(np.arange(len(ids)), times)
                    s = np.arange(len(at_row)) - np.repeat(np.cumsum(times) - times, times)
                    take = pa.array(at_row)
                    yield batch(o[at_row, i], s, side[at_row], 0, ids[at_row], 0, raw.take(take), order.take(take))

    def unpacked(b, kind, width):
        data = b"".join(b.to_pylist())
        return np.frombuffer(data, kind).reshape(-1, width)

    def search(batches):
        now, waiting, queries, members, n_members = None, [], None, [], 0

        def compare():
            held = Held(*(np.concatenate(x) for x in zip(*members)))
            for start in range(0, len(queries.ids), BLOCK):
                out = list(held.search(queries, slice(start, min(start + BLOCK, len(queries.ids))), k, share))
                counts = [len(ids) for _, ids, _, _ in out]
                if sum(counts):
                    visited = np.zeros(sum(counts), np.int64)
                    visited[np.concatenate(([0], np.cumsum(counts)[:-1]))[np.array(counts) > 0]] = [n for _, ids, _, n in out if len(ids)]
                    cols = [np.repeat(queries.ids[[q for q, *_ in out]], counts), np.concatenate([x for _, x, _, _ in out]), np.concatenate([d for _, _, d, _ in out]), visited]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "vec_id", "score", "n"])

        for b in batches:
            at = np.stack([b.column(c).to_numpy() for c in ("f", "s", "side", "kind")], axis=1)
            ends = np.append(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1, len(at)) if len(at) else []
            start = 0
            for end in ends:
                group, kind, piece = tuple(at[start, :3]), at[start, 3], b.slice(start, end - start)
                start = end
                if group != now:
                    if members and queries is not None:
                        yield from compare()
                    now, waiting, queries, members, n_members = group, [], None, [], 0
                ids, v = piece.column("id").to_numpy(), unpacked(piece.column("v"), "<f8", dim)
                if kind == 0:
                    waiting.append((ids, v, unpacked(piece.column("o"), "<i2", asked)))
                    continue
                if waiting:
                    queries, waiting = Asked(*(np.concatenate(x) for x in zip(*waiting)), size), []
                if queries is None:  # nobody asks this part
                    continue
                members.append((ids, v, unpacked(piece.column("o"), "<i2", prefix), piece.column("nth").to_numpy()))
                n_members += len(ids)
                if n_members >= CHUNK:
                    yield from compare()
                    members, n_members = [], 0
        if members and queries is not None:
            yield from compare()

    both = rows.mapInArrow(post, schema).unionAll(wanted.mapInArrow(ask, schema))
    # of about CROWD vectors each, so that the number of tasks grows with the rows
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(n * posts * sides / CROWD))
    ordered = both.repartition(tasks, "f", "s", "side").sortWithinPartitions("f", "s", "side", "kind")
    return ordered.mapInArrow(search, "query_id long, vec_id long, score double, n long")
