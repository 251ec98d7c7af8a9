"""N-gram Jaccard join by vertical partitioning.

The n-grams' 64-bit hashes give their global order, and equal ranges of it are the fragments.
Every document is cut into one segment for each fragment; overlaps are counted in each
fragment by itself and summed for each document or pair.  Steps:

1. Texts with the same n-gram set become one class, which its smallest key stands for.
2. For each class, the fragments count the n-grams that any other class has.  Linked
   texts share ``percent`` of either one's n-grams at least, so classes with fewer are done.  An n-gram that
   several classes in one batch of texts have counts for them there and then, and sends two of them
   to its fragment: so the most frequent n-grams cost least.
3. Those left are linked with the most central text that has the same MinHash value, under
   several functions, where the summed overlaps say so.  A group of copies so becomes one component by
   links to a few members, not by all its pairs.
4. Links may still be missing between components.  Again the fragments count, now n-grams that
   another component has.  They order by rank of frequency, then hash, behind all that none
   has.  What is left pairs up on the prefix of its order, between components only, if sizes and
   positions allow the overlap.
5. The pairs' partial overlaps are summed; the links of 3 and 5 give the components.

No link between texts of different components is lost, and pairs inside a component are never listed.
``similar_links`` counts them: each component's classes, in order of size, are cut into blocks, and
every two blocks whose sizes allow a link are compared in whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected
from .shared import Words, broadcast_if_small, distinct_sorted, few, materialize, mix, on_tasks, text_parts

#: N-grams that a fragment holds on average.
FRAGMENT = 2_000_000
#: Classes whose sums one task adds up, on average, and sums that a task holds before it passes them on; ANY: no key.
CLASSES, SUMS, ANY = 20_000, 1_000_000, -(1 << 63)
#: Places that are packed as one column with their owners, if fewer.
TOGETHER = 4096
#: Bytes of text that one step works on.
PART = 1 << 20
FUNCTIONS = 8
#: Ranks of frequency (by powers of two) in the order of what components share.
RANKS = 8
#: Texts and n-grams of a block whose links are counted, and n-grams compared at a time.
ROWS, GRAMS, COLUMNS = 1024, 1_000_000, 2048
_SALT = np.uint64(0xA0761D6478BD642F)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal for equal sets."""
    n = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((2, len(sets)), np.uint64)
    full = n > 0
    if full.any():
        every = np.concatenate(sets)
        starts = (np.cumsum(n) - n)[full]
        out[0, full] = mix(np.add.reduceat(mix(every), starts))
        out[1, full] = np.add.reduceat(mix(every ^ _SALT), starts)
    return out[0].view(np.int64), out[1].view(np.int64)


def _placed(h: np.ndarray, fragments: int) -> np.ndarray:
    """Fragment in the upper, place within it in the lower 32 bits; ascending with ``h``."""
    f, low = np.uint64(fragments), np.uint64(32)
    return (h >> low) * f + (((h & np.uint64(0xFFFFFFFF)) * f) >> low)


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(raw: bytes, at: int, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n).T.copy().view(kind).ravel()


def _pack(places: np.ndarray, owners: np.ndarray) -> bytes:
    """Ascending 32-bit places and 64-bit owners, compressed: column by column, or together where they are few."""
    ids, index = np.unique(owners, return_inverse=True)
    steps = np.diff(places.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    gaps = np.diff(ids.view(np.uint64), prepend=np.uint64(0)).astype("<u8")
    index = index.astype("<u1" if len(ids) <= 1 << 8 else "<u2" if len(ids) <= 1 << 16 else "<u4")
    columns = [_planes(x) for x in (steps, index, gaps)]
    if len(places) < TOGETHER:
        columns = [b"".join(columns)]
    frames = [zstandard.ZstdCompressor(level=1).compress(x) for x in columns]
    sizes = [len(x) for x in frames] + [0] * (3 - len(frames))
    return np.array([len(places), len(ids), index.itemsize, *sizes], "<i4").tobytes() + b"".join(frames)


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, k, width, *sizes = np.frombuffer(raw, "<i4", 6).tolist()
    ends = (24 + np.cumsum(sizes)).tolist()
    raw = b"".join(zstandard.ZstdDecompressor().decompress(raw[y - x : y]) for x, y in zip(sizes, ends) if x)
    places = np.cumsum(_from_planes(raw, 0, n, "<u4"), dtype=np.uint64)
    index = _from_planes(raw, 4 * n, n, f"<u{width}")
    ids = np.cumsum(_from_planes(raw, (4 + width) * n, k, "<u8"), dtype=np.uint64).view(np.int64)
    return places, ids[index]


def _summed(tables: list[np.ndarray]) -> np.ndarray:
    """(class, key, sum) rows with one row for each class and key."""
    o, k, s = np.concatenate(tables, axis=1)
    order = np.lexsort((k, o))
    o, k, s = o[order], k[order], s[order]
    start = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (k[1:] != k[:-1])))) if len(o) else np.empty(0, np.int64)
    return np.stack((o[start], k[start], np.add.reduceat(s, start) if len(o) else s))


def _sums_by_bucket(table: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(b, p): the rows of each bucket of classes, packed."""
    b = (np.ascontiguousarray(table[0]).view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    start = _runs(b[order])
    ends = np.append(start[1:], len(b))
    packed = [zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(table[:, order[x:y]]).astype("<i8").tobytes()) for x, y in zip(start, ends)]
    return pa.RecordBatch.from_arrays([pa.array(b[order][start], pa.int64()), pa.array(packed, pa.binary())], names=["b", "p"])


def _length(raw: bytes) -> int:
    """How many places were packed."""
    return int(np.frombuffer(raw, "<i4", 1)[0])


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in a sorted array."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)


def _spread(start: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(start, n)))


def shingle_sets(part: pa.RecordBatch, k: int) -> list[np.ndarray]:
    return distinct_sorted(*Words(part.column("t")).shingles(k))


class Join:
    """The steps over one table; ``run`` gives (key, n_shingles, component_id), ``counted`` the links too."""

    def __init__(self, docs: DataFrame, *, key: str, text: str, k: int, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent: over 0, up to 100")
        self.rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"), F.xxhash64(F.col(text).cast("string")).alias("h"))
        self.key, self.size, self.percent, self.functions = key, k, percent, FUNCTIONS

    def run(self) -> DataFrame:
        return self.placed().select(F.col("k").alias(self.key), F.col("n").alias("n_shingles"), "component_id")

    def placed(self) -> DataFrame:
        """(k, n, a, b, h, component_id) of each row; leaves the segments and the linked classes' components, if any."""
        self.left = self.parts = None
        rows = materialize(self.signed(), "signatures")
        classes = rows.where("n > 0 AND k IS NOT NULL").groupBy("a", "b", "n").agg(F.min("k").alias("rep"))
        classes = materialize(classes, "classes")
        total = classes.agg(F.sum("n")).first()[0] or 0
        left = materialize(self.shared_enough(classes, max(1, math.ceil(total / FRAGMENT))), "left")
        inside = left.agg(F.sum("n")).first()[0] or 0
        if inside:
            repeats = rows.groupBy("k").count().where("k IS NOT NULL AND count > 1").limit(1).count() > 0
            segments = materialize(self.segments(left, max(1, math.ceil(inside / FRAGMENT)), repeats), "segments")
            links = materialize(self.linked(self.stars(segments), segments), "star_links")
            parts = connected(links)
            more = self.linked(materialize(self.between(segments, parts), "candidates"), segments)
            found = connected(links.union(materialize(more, "links")))
            self.left, self.parts = segments, found
            classes = materialize(classes.join(found, classes["a"] == found["id"], "left").select("a", "b", "n", "rep", "label"), "labelled")
            least = materialize(classes.where("label IS NOT NULL").groupBy("label").agg(F.min("rep").alias("least")).withColumnRenamed("label", "l"), "least")
            classes = classes.join(least, F.col("label") == F.col("l"), "left").select("a", "b", "n", F.coalesce("least", "rep").alias("c"))
            classes = materialize(classes, "components")
        else:
            classes = classes.withColumnRenamed("rep", "c")
        named = classes.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("n").alias("z"), "c")
        own = F.when(F.col("k").isNotNull(), F.coalesce("c", "k"))
        return rows.join(named, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")) & (F.col("n") == F.col("z")), "left").select(
            "k", "n", "a", "b", "h", own.alias("component_id")
        )

    def counted(self) -> DataFrame:
        """(key, n_shingles, component_id, class_id, n_links)."""
        rows = materialize(self.placed(), "placed")
        sizes = rows.where("n > 0 AND k IS NOT NULL").groupBy("a", "b", "n").agg(F.min("k").alias("class_id"), F.count(F.lit(1)).alias("copies"))
        sizes = materialize(sizes.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("n").alias("z"), "class_id", "copies"), "sizes")
        if self.parts is None:
            sizes = sizes.withColumn("others", F.lit(0).cast("long"))
        else:
            sizes = sizes.join(materialize(self.inside(sizes), "inside"), F.col("x") == F.col("o"), "left").drop("o")
        on = (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")) & (F.col("n") == F.col("z")) & F.col("k").isNotNull()
        links = F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0))
        return rows.join(sizes, on, "left").select(
            F.col("k").alias(self.key), F.col("n").alias("n_shingles"), "component_id", F.coalesce("class_id", "k").alias("class_id"), links.alias("n_links")
        )

    def inside(self, sizes: DataFrame) -> DataFrame:
        """(o, others): for each class of a component the rows of the other classes that link with it."""
        percent = self.percent
        own = Window.partitionBy("label").orderBy("z", "id")
        upto = F.sum("z").over(own.rowsBetween(Window.unboundedPreceding, 0))
        block = F.floor((F.row_number().over(own) - 1) / F.lit(ROWS)) + F.floor((upto - 1) / F.lit(GRAMS))
        members = self.parts.join(sizes, self.parts["id"] == sizes["x"]).select("id", "label", "z", "copies", block.alias("block"))
        members = materialize(members, "members")
        blocks = members.groupBy("label", "block").agg(F.min("z").alias("lo"), F.max("z").alias("hi"), F.sum("z").alias("size"))
        small = blocks.select("label", F.col("block").alias("i"), "hi", F.col("size").alias("s"))
        large = blocks.select(F.col("label").alias("l"), F.col("block").alias("j"), "lo", F.col("size").alias("t"))
        fit = (F.col("label") == F.col("l")) & (F.col("i") <= F.col("j")) & (F.col("hi") * 100 >= F.col("lo") * percent)
        tasks = materialize(small.join(large, fit).select(F.col("label").alias("l"), "i", "j", (F.col("s") + F.col("t")).alias("size")), "tasks")
        total = tasks.agg(F.sum("size")).first()[0] or 0
        sides = tasks.select("l", "i", "j", F.col("i").alias("at"), F.lit(0).alias("side")).union(tasks.where("i < j").select("l", "i", "j", "j", F.lit(1)))
        held = self.left.join(members, F.col("k") == F.col("id")).select("label", "block", "k", "n", "copies", "g")
        rows = held.join(sides, (F.col("label") == F.col("l")) & (F.col("block") == F.col("at"))).select("l", "i", "j", "side", "k", "n", "copies", "g")

        def count(batches):
            now, pieces = None, []
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("l", "i", "j", "side", "k", "n", "copies", "g")]
                for l, i, j, *piece in zip(*cols):
                    if (l, i, j) != now:
                        if pieces:
                            yield _linked_rows(pieces, percent)
                        now, pieces = (l, i, j), []
                    pieces.append(piece)
            if pieces:
                yield _linked_rows(pieces, percent)

        parted = rows.repartition(max(1, math.ceil(total / FRAGMENT)), "l", "i", "j").sortWithinPartitions("l", "i", "j")
        return parted.mapInArrow(count, "o long, others long").groupBy("o").agg(F.sum("others").alias("others"))

    def signed(self) -> DataFrame:
        size = self.size

        def run(batches):
            for part in text_parts(batches, "t", PART):
                sets = shingle_sets(part, size)
                a, b = signatures(sets)
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array([len(s) for s in sets], pa.int64()), pa.array(a), pa.array(b), part.column("h")], names=["k", "n", "a", "b", "h"])

        return self.rows.mapInArrow(run, "k long, n long, a long, b long, h long")

    def shared_enough(self, classes: DataFrame, fragments: int) -> DataFrame:
        """Step 2: (a, rep, n, u: n-grams that no other has) of the classes that share ``percent`` of their n-grams with any others.

        What a batch credits to a class counts if it holds the class's own representative, so copies in
        other batches add nothing; a class may still be credited twice for an n-gram that only one of them could settle, so
        the count is never too small and at times too large.  It only says what is looked at further.
        """
        width = self.size

        def cut(batches):
            sets, owners, keys, size = [], [], [], 0

            def flush():
                ids = np.array(owners, np.int64)
                # copies in one batch count once, by the smallest key
                order = np.lexsort((np.array(keys, np.int64), ids))
                once = order[_runs(ids[order])]
                every = np.concatenate([sets[i] for i in once])
                who = np.repeat(np.arange(len(once)), [len(sets[i]) for i in once])
                order = np.argsort(every, kind="stable")
                every, who = every[order], who[order]
                start = _runs(every)
                per = np.diff(np.append(start, len(every)))
                here = np.repeat(per > 1, per)
                credit = np.bincount(who[here], minlength=len(once))
                # settled n-grams go on with two classes, the others with their own
                two = np.zeros(len(every), bool)
                two[start[per > 1]] = True
                two[start[per > 1] + 1] = True
                sent = ~here | two
                placed = _placed(every[sent], fragments)
                mine, settled = ids[once][who[sent]], here[sent]
                f = (placed >> np.uint64(32)).astype(np.int64)
                low = placed & np.uint64(0xFFFFFFFF)
                start = _runs(f)
                ends = np.append(start[1:], len(f))
                both = [(slice(x, y), settled[x:y]) for x, y in zip(start, ends)]
                packed = [_pack(low[at][~done], mine[at][~done]) for at, done in both]
                known = [_pack(low[at][done], mine[at][done]) for at, done in both]
                some = np.flatnonzero(credit)
                table = np.stack((ids[once][some], np.array(keys, np.int64)[once][some], credit[some])).astype("<i8").tobytes()
                where = [*f[start].tolist(), int(ids[once][0] % fragments)]
                return pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array([*packed, None], pa.binary()), pa.array([*known, None], pa.binary()), pa.array([None] * len(packed) + [table], pa.binary())], names=["f", "p", "q", "c"])

            for part in text_parts(batches, "t", PART):
                new = shingle_sets(part, width)
                ids, _ = signatures(new)
                for s, i, key in zip(new, ids.tolist(), part.column("k").to_pylist()):
                    if len(s):
                        sets.append(s)
                        owners.append(i)
                        keys.append(key)
                        size += len(s)
                if size >= FRAGMENT // 2:
                    yield flush()
                    sets, owners, keys, size = [], [], [], 0
            if size:
                yield flush()

        def count(batches):
            packed: dict[int, list[tuple[bytes, bytes]]] = {}
            held, size = [], 0
            for batch in batches:
                for f, p, q, c in zip(*(batch.column(x).to_pylist() for x in "fpqc")):
                    if c is None:
                        packed.setdefault(f, []).append((p, q))
                    else:
                        held.append(np.frombuffer(c, "<i8").reshape(3, -1))
            for f in sorted(packed):  # one at a time: a task may have drawn several
                found = packed.pop(f)
                places, owners = (np.concatenate(x) for x in zip(*(_unpack(x) for both in found for x in both)))
                open_ = np.concatenate([np.full(_length(x), i == 0) for both in found for i, x in enumerate(both)])
                order = np.argsort(places, kind="stable")
                places, owners, open_ = places[order], owners[order], open_[order]
                start = _runs(places)
                if not len(start):
                    continue
                many = np.minimum.reduceat(owners, start) != np.maximum.reduceat(owners, start)
                many = _spread(start, len(places), many) & open_
                places, owners = places[many], owners[many]
                order = np.lexsort((owners, places))
                places, owners = places[order], owners[order]
                once = np.ones(len(places), bool)
                once[1:] = (places[1:] != places[:-1]) | (owners[1:] != owners[:-1])
                ids, n = np.unique(owners[once], return_counts=True)
                held.append(np.stack((ids, np.full(len(ids), ANY), n)))
                size += len(ids)
                if size >= SUMS:
                    yield _sums_by_bucket(_summed(held), buckets)
                    held, size = [], 0
            if held:
                yield _sums_by_bucket(_summed(held), buckets)

        def total(batches):
            held, waiting, size = np.empty((3, 0), np.int64), [], 0
            for batch in batches:
                for raw in batch.column("p").to_pylist():
                    waiting.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<i8").reshape(3, -1))
                    size += waiting[-1].shape[1]
                    if size >= max(SUMS, held.shape[1]):
                        held, waiting, size = _summed([held, *waiting]), [], 0
            o, k, s = _summed([held, *waiting])
            if len(o):
                yield pa.RecordBatch.from_arrays([pa.array(o), pa.array(k, mask=k == ANY), pa.array(s)], names=["o", "k", "s"])

        # sums of one task go on packed, by a hash of the class, and meet those of the other tasks there
        buckets = max(1, math.ceil(classes.count() / CLASSES))
        cuts = self.rows.where("k IS NOT NULL AND t IS NOT NULL").select("k", "t").mapInArrow(cut, "f long, p binary, q binary, c binary")
        parts = on_tasks(cuts, fragments, "f").mapInArrow(count, "b long, p binary")
        counts = on_tasks(parts, buckets, "b").mapInArrow(total, "o long, k long, s long")
        own = classes.join(counts, (classes["a"] == counts["o"]) & (F.col("k").isNull() | (F.col("k") == F.col("rep"))))
        sums = own.groupBy("a", "rep", "n").agg(F.least(F.sum("s"), F.col("n")).alias("s"))
        return sums.where(F.col("s") * 100 >= F.col("n") * self.percent).select("a", "rep", "n", (F.col("n") - F.col("s")).alias("u"))

    def segments(self, left: DataFrame, fragments: int, repeats: bool) -> DataFrame:
        """The n-grams of the classes left: a row (f, k, n, g, m, u) for each fragment that has any.

        From here on, k is the class's signature.  m and u: MinHash values and the number of
        n-grams of its own, in the first segment only.
        A key that stands for several rows may bring other classes' texts, which are left out,
        and with ``repeats`` the same text twice.
        """
        size = self.size
        factors = mix(np.arange(11, 11 + self.functions, dtype=np.uint64)) | np.uint64(1)

        def run(batches):
            for part in text_parts(batches, "t", PART):
                out = []
                sets = shingle_sets(part, size)
                for k, u, own, s in zip(part.column("a").to_pylist(), part.column("u").to_pylist(), signatures(sets)[0].tolist(), sets):
                    if own != k:
                        continue
                    f = (_placed(s, fragments) >> np.uint64(32)).astype(np.int64)
                    start = _runs(f)
                    least = [int((s * x).min().view(np.int64)) for x in factors]
                    for x, y in zip(start.tolist(), [*start[1:].tolist(), len(s)]):
                        out.append((int(f[x]), k, len(s), s[x:y].tobytes(), least, u))
                        least = u = None
                cols = list(zip(*out)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["f", "k", "n", "g", "m", "u"])

        texts = self.rows.join(broadcast_if_small(left), F.col("k") == F.col("rep")).select("a", "u", "t")
        if repeats:
            texts = texts.dropDuplicates(["a", "t"])
        return texts.mapInArrow(run, "f long, k long, n long, g binary, m array<long>, u long")

    def stars(self, segments: DataFrame) -> DataFrame:
        """Step 3: pairs of each text and the hub of those that share a MinHash value with it.

        The hub has the fewest n-grams of its own, as the text has that the others were copied from.
        """
        central = F.shiftleft(F.least("u", F.lit((1 << 22) - 1)), 40) + F.col("k").bitwiseAND((1 << 40) - 1)
        values = segments.where("m IS NOT NULL").select("k", central.alias("o"), F.posexplode("m").alias("i", "v"))
        values = materialize(values, "minhash")
        hubs = values.groupBy("i", "v").agg(F.min_by("k", "o").alias("a"), F.count(F.lit(1)).alias("z")).where("z > 1").select(F.col("i").alias("j"), F.col("v").alias("w"), "a")
        hubs = materialize(hubs, "hubs")
        met = values.join(hubs, (F.col("i") == F.col("j")) & (F.col("v") == F.col("w"))).where("k <> a")
        return materialize(met.select(F.least("a", "k").alias("a"), F.greatest("a", "k").alias("b")).distinct(), "stars")

    def linked(self, pairs: DataFrame, segments: DataFrame) -> DataFrame:
        """The pairs (a, b) whose overlaps, summed over the fragments, reach ``percent``."""

        def count(batches):
            for batch in batches:
                n = [
                    len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("a", "b", "na", "nb")], pa.array(n, pa.int64())], names=["a", "b", "na", "nb", "c"])

        left = segments.select(F.col("k").alias("ka"), F.col("n").alias("na"), F.col("f").alias("fa"), F.col("g").alias("x"))
        right = segments.select(F.col("k").alias("kb"), F.col("n").alias("nb"), F.col("f").alias("fb"), F.col("g").alias("y"))
        if few(pairs):  # then only the segments they ask for are shuffled
            pairs = F.broadcast(pairs)
            right = right.join(F.broadcast(pairs.select("b").distinct()), F.col("kb") == F.col("b"), "left_semi")
        rows = pairs.join(left, F.col("a") == F.col("ka")).join(right, (F.col("b") == F.col("kb")) & (F.col("fa") == F.col("fb")))
        part = rows.select("a", "b", "na", "nb", "x", "y").mapInArrow(count, "a long, b long, na long, nb long, c long")
        total = part.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"))
        return total.where(F.col("c") * 100 >= (F.col("na") + F.col("nb") - F.col("c")) * self.percent).select("a", "b")

    def between(self, segments: DataFrame, parts: DataFrame) -> DataFrame:
        """Step 4: candidate pairs (a, b) of different components."""
        percent = self.percent
        named = segments.join(parts, segments["k"] == parts["id"], "left").select("f", "k", "n", "g", F.coalesce("label", "k").alias("c"))
        named = materialize(named, "named_segments")
        fragments = named.select(F.max("f")).first()[0] + 1

        def postings(batches, extra=()):
            cols = {c: [] for c in ("k", "n", "c", "g", *extra)}
            for batch in batches:
                for c, v in cols.items():
                    v.extend(batch.column(c).to_pylist())
            size = np.array([len(g) // 8 for g in cols["g"]], np.int64)
            if not len(size):
                return None
            row = np.repeat(np.arange(len(size)), size)
            h = np.frombuffer(b"".join(cols["g"]), np.uint64)
            meta = {c: np.array(v, np.int64) for c, v in cols.items() if c != "g"}
            order = np.lexsort((meta["c"][row], h))
            start = _runs(h[order])
            comp = meta["c"][row][order]
            cross = np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start)
            often = np.log2(np.diff(np.append(start, len(h)))).astype(np.int64).clip(1, RANKS)
            return meta, row[order], h[order], _spread(start, len(h), np.where(cross, often, 0))

        def count(batches):
            held = postings(batches, ("f",))
            if held:
                meta, row, _, rank = held
                n = np.bincount(row * (RANKS + 1) + rank, minlength=len(meta["k"]) * (RANKS + 1)).reshape(-1, RANKS + 1)
                yield pa.RecordBatch.from_arrays([pa.array(meta["f"]), pa.array(meta["k"]), *[pa.array(n[:, r].astype(np.int64)) for r in range(RANKS + 1)]], names=["f2", "k2", *[f"x{r}" for r in range(RANKS + 1)]])

        crossed = on_tasks(named, fragments, "f").mapInArrow(count, "f2 long, k2 long, " + ", ".join(f"x{r} long" for r in range(RANKS + 1)))
        crossed = materialize(crossed, "crossed")
        own = Window.partitionBy("k2")
        earlier = own.orderBy("f2").rowsBetween(Window.unboundedPreceding, -1)
        sums = crossed.select("f2", "k2", *[F.sum(f"x{r}").over(own).alias(f"all{r}") for r in range(RANKS + 1)], *[F.coalesce(F.sum(f"x{r}").over(earlier), F.lit(0)).alias(f"b{r}") for r in range(RANKS + 1)])
        total = lambda upto: sum((F.col(f"all{r}") for r in range(1, upto)), F.col("all0"))
        places = sums.where((total(RANKS + 1) - F.col("all0")) * 100 >= total(RANKS + 1) * percent).select("f2", "k2", *[(total(r) + F.col(f"b{r}")).alias(f"at{r}") for r in range(1, RANKS + 1)])
        places = materialize(places, "places")
        # texts that are out keep their segments here: they decide what is shared between components
        starts = [f"at{r}" for r in range(1, RANKS + 1)]
        rows = named.join(places, (F.col("f") == F.col("f2")) & (F.col("k") == F.col("k2")), "left").select("f", "k", "n", "c", "g", *[F.coalesce(x, F.lit(-1)).alias(x) for x in starts])

        def pairs(batches):
            held = postings(batches, starts)
            if not held:
                return
            meta, row, h, rank = held
            base = np.stack([meta[x] for x in starts])
            use = (rank > 0) & (base[0][row] >= 0)
            row, h, rank = row[use], h[use], rank[use]
            # place of each n-gram in its text: those of its rank before this segment, then inside it
            group = row * (RANKS + 1) + rank
            by = np.argsort(group, kind="stable")
            first = _runs(group[by])
            at = np.empty(len(row), np.int64)
            at[by] = np.arange(len(row)) - _spread(first, len(row), first)
            at += base[rank - 1, row]
            n = meta["n"][row]
            use = at < n - -(-n * percent // 100) + 1
            row, h, at, n = row[use], h[use], at[use], n[use]
            k, comp = meta["k"][row], meta["c"][row]
            start = _runs(h)
            ends = np.append(start[1:], len(h))
            out, size = [], 0
            for x, y in zip(start[ends - start > 1].tolist(), ends[ends - start > 1].tolist()):
                block = x + _runs(comp[x:y])
                for u, v in zip(block[:-1].tolist(), block[1:].tolist()):  # this component against all behind it
                    for i in range(u, v):
                        both = n[i] + n[v:y]
                        room = np.minimum(n[i] - at[i], n[v:y] - at[v:y])
                        ok = (room * (100 + percent) >= both * percent) & (np.minimum(n[i], n[v:y]) * 100 >= np.maximum(n[i], n[v:y]) * percent)
                        if ok.any():
                            other = k[v:y][ok]
                            out.append(np.stack((np.minimum(k[i], other), np.maximum(k[i], other)), axis=1))
                            size += len(other)
                if size >= 1_000_000:
                    yield _pair_batch(out)
                    out, size = [], 0
            if out:
                yield _pair_batch(out)

        return on_tasks(rows, fragments, "f").mapInArrow(pairs, "a long, b long").where("a <> b").distinct()


def _pair_batch(pairs: list[np.ndarray]) -> pa.RecordBatch:
    ab = np.concatenate(pairs)
    order = np.lexsort((ab[:, 1], ab[:, 0]))
    ab = ab[order]
    ab = ab[np.concatenate(([True], (ab[1:] != ab[:-1]).any(axis=1)))]
    return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])


def _linked_rows(pieces: list, percent: int) -> pa.RecordBatch:
    """(o, others) from segments (side, k, n, copies, g) of two blocks, or of one with side 0 only."""
    side, k, n, copies = (np.array(c, np.int64) for c in list(zip(*pieces))[:4])
    h = np.frombuffer(b"".join(p[4] for p in pieces), np.uint64)
    row = np.repeat(np.arange(len(pieces)), [len(p[4]) // 8 for p in pieces])
    texts, first, at = np.unique(k, return_index=True, return_inverse=True)
    n, copies, side = n[first], copies[first], side[first]
    order = np.argsort(h, kind="stable")
    h, text = h[order], at[row[order]]
    start = _runs(h)
    many = np.diff(np.append(start, len(h))) > 1
    use = _spread(start, len(h), many)
    gram, text = _spread(start, len(h), np.cumsum(many) - 1)[use], text[use]
    place = np.empty(len(texts), np.int64)  # of each text in its block
    for x in (0, 1):
        place[side == x] = np.arange((side == x).sum())
    one = not side.any()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if one else 1))
    both = np.zeros((len(left), len(right)))
    for base in range(0, int(many.sum()), COLUMNS):
        x, y = np.searchsorted(gram, (base, base + COLUMNS))
        has = [np.zeros((len(b), COLUMNS), np.float32) for b in ((left,) if one else (left, right))]
        for s, dense in enumerate(has):
            mine = side[text[x:y]] == s
            dense[place[text[x:y][mine]], gram[x:y][mine] - base] = 1
        both += has[0] @ has[-1].T
    both = both.astype(np.int64)
    link = both * 100 >= (n[left][:, None] + n[right][None, :] - both) * percent
    if one:
        np.fill_diagonal(link, False)
        found = link @ copies[right]
        return pa.RecordBatch.from_arrays([pa.array(texts[left]), pa.array(found)], names=["o", "others"])
    found = np.concatenate((link @ copies[right], copies[left] @ link))
    return pa.RecordBatch.from_arrays([pa.array(texts[np.concatenate((left, right))]), pa.array(found)], names=["o", "others"])


def similar_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: key (an integer), n_shingles, component_id.

    Two texts link when ``100 * intersection >= percent * union`` for their sets of distinct
    ``k``-word shingles; with fewer words, the whole sequence is the one shingle.  Null and empty texts
    and those of white space have none and link with nothing.  A row with a null key has no
    component and links nothing.  Of rows with one key and different texts, each belongs to the
    component of its own text.  An empty table gives no rows; other columns are ignored.
    """
    return Join(docs, key=key, text=text, k=k, percent=percent).run()


def similar_links(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``similar_components`` with class_id and n_links.

    class_id: the smallest key with the same n-gram set.  n_links: the exact number of other rows whose
    texts link with the row's, rows with an equal set and rows of the same key among them.  Rows
    without n-grams are a class of their own; they and rows with a null key have no links.
    """
    return Join(docs, key=key, text=text, k=k, percent=percent).counted()


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that with the smallest key.

    Of several rows with the smallest key, that with the smallest hash of its text stays, and of rows
    equal in key and text that with the smallest other columns; rows of one key whose texts don't
    link are components of their own.  Rows with a null key or without words stay, all of them; an empty
    table stays empty.
    """
    join = Join(docs, key=key, text=text, k=5, percent=percent)
    placed = materialize(join.placed(), "placed").where("k IS NOT NULL AND n > 0")
    if not placed.groupBy("k").agg(F.count(F.lit(1)).alias("m")).where("m > 1").limit(1).count():
        found = placed.where("component_id <> k").select(F.col("k").alias("gone__"))
        return docs.join(materialize(found, "gone"), docs[key].cast("long") == F.col("gone__"), "left_anti")
    # a component goes by its label here, as several may share their smallest key
    if join.parts is not None:
        placed = placed.join(join.parts, placed["a"] == join.parts["id"], "left").withColumn("g", F.coalesce("label", "a"))
    else:
        placed = placed.withColumn("g", F.col("a"))
    rows = materialize(placed.groupBy("g", "k", "h").agg(F.count(F.lit(1)).alias("m")), "texts_of_keys")
    firsts = rows.groupBy("g").agg(F.min(F.struct("k", "h")).alias("x")).select(F.col("x.k").alias("k"), F.col("x.h").alias("h")).distinct()
    gone = rows.join(firsts, ["k", "h"], "left_anti").select(F.col("k").alias("k__"), F.col("h").alias("h__"))
    copies = rows.join(firsts, ["k", "h"]).groupBy("k", "h").agg(F.sum("m").alias("m")).where("m > 1").select(F.col("k").alias("k__"), F.col("h").alias("h__"))
    gone, copies = materialize(gone, "gone"), broadcast_if_small(materialize(copies, "copies"))
    on = (docs[key].cast("long") == F.col("k__")) & (F.xxhash64(docs[text].cast("string")) == F.col("h__"))
    left = docs.join(broadcast_if_small(gone), on, "left_anti")
    plain = [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant", "array", "struct")]
    least = F.min_by(F.struct(*docs.columns), F.struct(*plain))
    one = left.join(copies, on).groupBy("k__", "h__").agg(least.alias("row__")).select("row__.*")
    return left.join(copies, on, "left_anti").unionByName(one)


def components_sql(percent: int = 80) -> str:
    """The same by brute force in DuckDB SQL."""
    words = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
 s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END, ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
 l AS MATERIALIZED (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
 r(a, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.a = w.doc_id GROUP BY w.doc_id"""
