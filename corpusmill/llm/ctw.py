"""Language-model scoring by context-tree weighting over binary-decomposed byte contexts.

Training counts every byte with the five before it.  All 256 bytes are symbols; text start and
text end are two that UTF-8 never has.  A byte is eight binary decisions; each has a context tree over the last 0 to 5
bytes, whose nodes hold Krichevsky-Trofimov (KT) estimates.  A node's weighted probability is
half its own estimate and half the product of its children's; from that follows the weight of
every depth, and the prediction mixes the estimates of all of them.  The score of a text is its log10 probability, text end
included.

No machine holds the model, which grows with the corpus.  Contexts that share their last two
symbols lie in one fragment, whose subtrees need nothing else but the mixture of the depths
above; that comes from sums over at most 256 * 255 decisions.  Texts ask the fragments for the
distinct grams of each part of about two MB and add up the answers.  With many parts a fragment
has several copies, which share them out.

A base line of single words is computed beside it: exact counts over all training tokens.  Each
part sends its distinct words with their training counts to the words' fragments and gets the
sums back.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, materialize, mix, text_buffers, text_parts

DEPTH, BITS = 5, 6
#: Binary decisions of a byte, as the operator codes it; models of BITS decisions serve smaller alphabets.
BYTE = 8
#: Symbols of context that a fragment's grams share, and grams that a fragment holds on average.
SPLIT, MODEL_FRAGMENT = 2, 250_000
#: Text start, text end and any other byte in a smaller alphabet.
START, END, ESCAPE = 0, 1, 2
#: Bytes that UTF-8 never has: before the text's first byte and after its last.
PAD, STOP = 0xFE, 0xFF
#: Bytes of text for one fragment of the words; a part posts each of its words once, so a frequent word has one posting a part.
FRAGMENT = 40_000_000
#: Grams that a task holds before it passes them on.
HELD_GRAMS = 8_000_000
#: Grams that one copy of a fragment answers on average, if a part asks for one in four of its bytes; above, a
#: fragment has copies, each for its share of the parts.
ANSWERED = 4_000_000
#: Bytes of text that one step works on.
PART = 1 << 19
#: Bytes of text that ask for their grams together.
ASKED = 1 << 21


# ---------------------------------------------------------------- the model


def lgamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series eight steps up."""
    z = x + 8.0
    low = np.ones_like(z)
    for i in range(8):
        low *= x + i
    inv = 1.0 / z
    series = inv * (1 / 12 - inv * inv * (1 / 360 - inv * inv * (1 / 1260 - inv * inv / 1680)))
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(low)


def kt_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the KT probability of any sequence with these counts."""
    out = np.empty(len(zeros))
    for i in range(0, len(zeros), 1 << 16):  # few temporaries at a time
        a, b = zeros[i : i + (1 << 16)], ones[i : i + (1 << 16)]
        out[i : i + (1 << 16)] = lgamma(a + 0.5) + lgamma(b + 0.5) - math.log(math.pi) - lgamma(a + b + 1.0)
    return out


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)


def _in(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each x among sorted values."""
    if not len(sorted_values):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return at, sorted_values[at] == x


def _levels(by_depth, level: int, low: int, bits: int):
    """The decisions of one level in contexts of ``low`` to DEPTH symbols: (node, zeros, ones) by depth,
    the place of each one's parent, the weight of the own estimate, and ln of the weighted probability at ``low``."""
    shift, symbols, nodes, parent, weight = bits - level, 1 << bits, {}, {}, {}
    for d in range(low, DEPTH + 1):
        g, n = by_depth[d]
        node = g >> shift
        start = _starts(node)
        ones = np.add.reduceat(n * (g >> (shift - 1) & 1), start)
        nodes[d] = node[start], np.add.reduceat(n, start) - ones, ones
    for d in range(low + 1, DEPTH + 1):  # the same decision, the context without its oldest symbol
        q = nodes[d][0]
        parent[d] = np.searchsorted(nodes[d - 1][0], ((q >> level) % symbols ** (d - 1) << level) | (q & (1 << level) - 1))
    total = None
    for d in range(DEPTH, low - 1, -1):
        own = kt_block(nodes[d][1], nodes[d][2])
        if d == DEPTH:
            weight[d], total = np.ones_like(own), own
        else:
            under = np.bincount(parent[d + 1], weights=total, minlength=len(own))
            total = math.log(0.5) + np.logaddexp(own, under)
            weight[d] = np.exp(math.log(0.5) + own - total)
    return nodes, parent, weight, total


def _key(q: np.ndarray, level: int, depth: int, bits: int) -> np.ndarray:
    """``context * 2**bits + decision`` of a node of this level, its context cut to ``depth`` symbols."""
    return ((q >> level) % (1 << bits * depth) << bits) | 1 << level | (q & (1 << level) - 1)


def _by_depth(grams: np.ndarray, counts: np.ndarray, low: int, bits: int) -> dict:
    """(grams, counts) of contexts of each depth; ``grams`` ascend."""
    out = {DEPTH: (grams, counts)}
    for d in range(DEPTH - 1, low - 1, -1):
        g = out[d + 1][0] % (1 << bits * (d + 1))
        order = np.argsort(g, kind="stable")
        start = _starts(g[order])
        out[d] = (g[order][start], np.add.reduceat(out[d + 1][1][order], start) if len(g) else counts)
    return out


def top_sums(grams: np.ndarray, counts: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, zeros, ones, under) of the decisions above one fragment's subtrees, in contexts of
    SPLIT - 1 symbols; under: the summed ln of the subtrees' weighted probabilities."""
    order = np.argsort(grams)
    by_depth = _by_depth(grams[order], counts[order].astype(np.float64), SPLIT, bits)
    found = []
    for level in range(bits if len(grams) else 0):
        nodes, _, _, total = _levels(by_depth, level, SPLIT, bits)
        keys, index = np.unique(_key(nodes[SPLIT][0], level, SPLIT - 1, bits), return_inverse=True)
        found.append((keys, *(np.bincount(index, weights=x) for x in (nodes[SPLIT][1], nodes[SPLIT][2], total))))
    return tuple(np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64 if not i else float) for i in range(4))


def top_nodes(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, under: np.ndarray, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, mixed, rest) by depth, of contexts with fewer than SPLIT symbols, from all fragments' sums."""
    order = np.argsort(keys)
    levels = [(keys[order], zeros[order], ones[order], under[order])]
    weights, ups = [], []
    for d in range(SPLIT - 1, -1, -1):
        k, z, o, u = levels[-1]
        own = kt_block(z, o)
        total = math.log(0.5) + np.logaddexp(own, u)
        weights.append(np.exp(math.log(0.5) + own - total))
        if d:
            above, index = np.unique(((k >> bits) % (1 << bits * (d - 1)) << bits) | k & ((1 << bits) - 1), return_inverse=True)
            ups.append(index)
            levels.append((above, *(np.bincount(index, weights=x, minlength=len(above)) for x in (z, o, total))))
    out, mixed, rest = [], None, None
    for i in range(SPLIT - 1, -1, -1):
        k, z, o, _ = levels[i]
        mixed, rest = (np.zeros(len(k)), np.ones(len(k))) if mixed is None else (mixed[ups[i]], rest[ups[i]])
        mixed, rest = mixed + rest * weights[i] * (o + 0.5) / (z + o + 1.0), rest * (1 - weights[i])
        out.append((k, mixed, rest))
    return out


class Model:
    """Predicts a symbol from the DEPTH before it.

    A gram is ``context * 2**bits + symbol``; a context's last symbol is its lowest digit.
    ``logp``: log10 probability of each gram seen.  ``nodes[d]``: the decisions seen in contexts
    of d < DEPTH symbols, as (keys, mixed, rest): the weighted sum of the estimates of depths
    0 to d, and the weight left to deeper ones.  With ``top`` from ``top_nodes`` the grams are
    those of one fragment, else all.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, top=None, bits: int = BITS):
        self.bits = bits
        low = 0 if top is None else SPLIT
        order = np.argsort(grams)
        self.grams, counts = grams[order], counts[order].astype(np.float64)
        self.before = np.concatenate(([0.0], np.cumsum(counts)))
        by_depth = _by_depth(self.grams, counts, low, bits)
        logp, parts = np.zeros(len(grams)), {d: [] for d in range(low, DEPTH)}
        for level in range(bits if len(grams) else 0):
            self._level(level, by_depth, logp, parts, low, top)
        self.logp = logp.astype(np.float32)
        self.nodes = list(top or ())
        for d in range(low, DEPTH):
            keys, mixed, rest = (np.concatenate([f[i] for f in parts[d]]) if parts[d] else np.empty(0, np.int64) for i in range(3))
            order = np.argsort(keys)
            self.nodes.append((keys[order], mixed[order], rest[order]))
        self.slots = self._slots()

    def _level(self, level: int, by_depth, logp: np.ndarray, parts: dict, low: int, top) -> None:
        """Mixes the trees of the decisions of one level; adds to logp and parts."""
        shift = self.bits - level
        nodes, parent, weight, _ = _levels(by_depth, level, low, self.bits)
        if top is None:
            mixed, rest = np.zeros(len(nodes[0][0])), np.ones(len(nodes[0][0]))
        else:
            keys, mixed, rest = top[-1]
            at = np.searchsorted(keys, _key(nodes[low][0], level, low - 1, self.bits))
            mixed, rest = mixed[at], rest[at]
        for d in range(low, DEPTH + 1):
            q, zeros, ones = nodes[d]
            if d > low:
                mixed, rest = mixed[parent[d]], rest[parent[d]]
            mixed, rest = mixed + rest * weight[d] * (ones + 0.5) / (zeros + ones + 1.0), rest * (1 - weight[d])
            if d < DEPTH:
                parts[d].append((_key(q, level, d, self.bits), mixed.astype(np.float32), rest.astype(np.float32)))
        at = np.cumsum(np.concatenate(([0], (self.grams[1:] >> shift != self.grams[:-1] >> shift).astype(np.int64))))
        logp += np.log10(np.where(self.grams >> (shift - 1) & 1, mixed[at], 1 - mixed[at]))

    def _slots(self) -> np.ndarray:
        """A hash table of places in ``grams`` (-1: none), at most half full, probed step by step."""
        bits = max(4, int(2 * len(self.grams)).bit_length())
        slots = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(self.grams), dtype=np.int32)
        at = self._slot(self.grams, bits)
        while len(left):
            free = slots[at] < 0
            slots[at[free]] = left[free]
            lost = slots[at] != left
            left, at = left[lost], (at[lost] + 1) & ((1 << bits) - 1)
        return slots

    @staticmethod
    def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
        return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def places(self, grams: np.ndarray) -> np.ndarray:
        """The place of each gram in ``grams``, -1 if never seen."""
        if not len(self.grams):
            return np.full(len(grams), -1, np.int32)
        mask = len(self.slots) - 1
        at = self._slot(grams, mask.bit_length())
        found = self.slots[at]
        left = np.flatnonzero((found >= 0) & (self.grams[found] != grams))
        at = at[left]
        while len(left):
            at = (at + 1) & mask
            found[left] = self.slots[at]
            more = (found[left] >= 0) & (self.grams[found[left]] != grams[left])
            left, at = left[more], at[more]
        return found

    def unseen(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of grams that training never saw."""
        out = np.zeros(len(grams))
        bits = self.bits
        context, symbol = grams >> bits, grams & ((1 << bits) - 1)
        known = _in(self.grams[_starts(self.grams >> bits)] >> bits, context)[1]
        for level in range(bits):
            shift = bits - level
            decision = 1 << level | symbol >> shift
            bit = symbol >> (shift - 1) & 1
            p = np.full(len(grams), 0.5)
            left = np.arange(len(grams))
            for d in range(DEPTH - 1, -1, -1):
                keys, mixed, rest = self.nodes[d]
                at, there = _in(keys, (context[left] % (1 << bits * d) << bits) | decision[left])
                hit, at = left[there], at[there]
                deeper = np.full(len(hit), 0.5)
                if d == DEPTH - 1:
                    use = np.flatnonzero(known[hit])
                    low = (grams[hit[use]] >> shift) << shift
                    ends = [self.before[np.searchsorted(self.grams, low + x)] for x in (0, 1 << (shift - 1), 1 << shift)]
                    deeper[use] = (ends[2] - ends[1] + 0.5) / (ends[2] - ends[0] + 1.0)
                p[hit] = mixed[at] + rest[at] * deeper
                left = left[~there]
                if not len(left):
                    break
            out += np.log10(np.where(bit == 1, p, 1 - p))
        return out

    def ask(self, grams: np.ndarray) -> np.ndarray:
        """The log10 probability of each gram, seen or not; ``grams`` are distinct."""
        at = self.places(grams)
        out = self.logp[at] if len(self.logp) else np.zeros(len(grams), np.float32)
        new = np.flatnonzero(at < 0)
        out[new] = self.unseen(grams[new])
        return out


def distinct_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values as they come, the place among them of each): a hash table, not a sort."""
    coded = pa.array(values).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


class Part:
    """The grams of some texts: ``distinct`` ones by fragment, ``ends`` of each fragment's."""

    def __init__(self, array, fragments: int):
        self.first, self.data = padded(array)
        if len(self.first) < 2:
            self.distinct, self.ends = np.empty(0, np.int64), np.zeros(fragments, np.int64)
            return
        self.coded = self.data != PAD
        self.coded[:DEPTH] = False
        self.grams = byte_grams(self.data)[self.coded[DEPTH:]]
        ascending = np.sort(self.grams)
        self.ascending = ascending[_starts(ascending)]
        f = fragment_of(self.ascending, fragments, BYTE).astype(np.uint16 if fragments <= 1 << 16 else np.int64)
        self.order = np.argsort(f, kind="stable")
        self.distinct, self.ends = self.ascending[self.order], np.cumsum(np.bincount(f, minlength=fragments))

    def scores(self, answers: np.ndarray) -> np.ndarray:
        """The log10 probability of each text; ``answers`` are those to ``distinct``."""
        if len(self.first) < 2:
            return np.empty(0)
        each = np.empty(len(answers))
        each[self.order] = answers
        # a sparse table finds most grams at once, a search those that share a slot with another
        bits = max(4, (8 * len(each)).bit_length())
        slots = np.zeros(1 << bits, np.int32)
        slots[Model._slot(self.ascending, bits)] = np.arange(len(each), dtype=np.int32)
        at = slots[Model._slot(self.grams, bits)]
        lost = np.flatnonzero(self.ascending[at] != self.grams)
        at[lost] = np.searchsorted(self.ascending, self.grams[lost])
        # every text has its byte count and the end as grams, one after the other
        return np.add.reduceat(each[at], self.first[:-1] - DEPTH * np.arange(len(self.first) - 1))


def fragment_of(grams: np.ndarray, fragments: int, bits: int = BITS) -> np.ndarray:
    """The fragment of each gram, by the last SPLIT symbols of its context."""
    return (mix((grams >> bits) % (1 << bits * SPLIT) + 1) % np.uint64(fragments)).astype(np.int64)


def padded(array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes): each text lower-cased (A-Z), after DEPTH times PAD and before one STOP."""
    offsets, data = text_buffers(array)
    n, extra = len(offsets) - 1, DEPTH + 1
    low = data + np.uint8(32) * ((data >= 65) & (data <= 90)).astype(np.uint8)
    out = np.full(len(low) + extra * n, PAD, np.uint8)
    first = offsets + extra * np.arange(n + 1)
    out[first[1:] - 1] = STOP
    out[np.arange(len(low)) + DEPTH + extra * np.repeat(np.arange(n), np.diff(offsets))] = low
    return first, out


def byte_grams(b: np.ndarray) -> np.ndarray:
    """The gram of each padded byte from the first text's on: itself and the DEPTH bytes before."""
    g = b[DEPTH:].astype(np.int64)
    for d in range(1, DEPTH + 1):
        g |= b[DEPTH - d : len(b) - d].astype(np.int64) << (BYTE * d)
    return g


def grams(array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the texts (DEPTH bytes of context, one coded) and their counts."""
    _, b = padded(array)
    if not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(byte_grams(b)[b[DEPTH:] != PAD], return_counts=True)


def packed_texts(array) -> tuple[bytes, pa.Array]:
    """The texts' bytes together, compressed, and the length of each."""
    offsets, data = text_buffers(array)
    return zstandard.ZstdCompressor(level=3).compress(data.tobytes()), pa.array(np.diff(offsets), pa.int64())


def unpacked_texts(raw: bytes, lengths: pa.Array) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths.to_numpy(zero_copy_only=False)))).astype(np.int64)
    data = zstandard.ZstdDecompressor().decompress(raw)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def packed_floats(values: np.ndarray) -> bytes:
    """Single floats as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<f4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked_floats(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1).T.copy().view("<f4").ravel()


def packed_numbers(ascending: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Ascending numbers as byte planes of their steps, with a count each."""
    planes = lambda x: x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    raw = planes(np.diff(ascending, prepend=0)) + (b"" if counts is None else planes(counts))
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked_numbers(raw: bytes, counted: bool = False):
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    number = lambda x: x.reshape(8, -1).T.copy().view("<i8").ravel()
    if not counted:
        return np.cumsum(number(data))
    return np.cumsum(number(data[: len(data) // 2])), number(data[len(data) // 2 :])


class Trees:
    """The model of a table (g, n) of byte grams, by fragments in a written table."""

    def __init__(self, counts: DataFrame):
        coded = materialize(counts.select("g", "n"), "grams")
        self.fragments = fragments = max(1, math.ceil(coded.count() / MODEL_FRAGMENT))

        def pack(batches):
            for b in batches:
                g, n = b.column("g").to_numpy(), b.column("n").to_numpy()
                f = fragment_of(g, fragments, BYTE)
                order = np.lexsort((g, f))
                ends = np.cumsum(np.bincount(f, minlength=fragments))
                for x in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
                    at = order[ends[x - 1] if x else 0 : ends[x]]
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()), pa.array([packed_numbers(g[at], n[at])], pa.binary())], names=["f", "v"])

        def sums(batches):
            for _, pieces in by_fragment(batches):
                columns = top_sums(*merged(pieces), BYTE)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "zeros", "ones", "under"])

        self.pieces = materialize(coded.mapInArrow(pack, "f long, v binary").repartition(fragments, "f").sortWithinPartitions("f"), "fragments")
        shared = self.pieces.repartition(fragments, "f").sortWithinPartitions("f").mapInArrow(sums, "key long, zeros double, ones double, under double")
        got = shared.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "under")]).toArrow()  # 256 * 255 rows at most
        self.top = top_nodes(*(got.column(c).to_numpy() for c in ("key", "zeros", "ones", "under")), BYTE)

    def answered(self, asked: DataFrame, parts: int) -> DataFrame:
        """(p, f, v): the answers to rows (p, f, v) of packed grams from so many parts.

        Part p asks copy ``hash(p) % copies`` of a fragment, so that a hot fragment's work is shared
        and grows with ANSWERED, not with the corpus.
        """
        fragments, top = self.fragments, self.top
        copies = max(1, math.ceil(parts * ASKED / 4 / fragments / ANSWERED))

        def run(batches):
            now, pieces, model = None, [], None
            for b in batches:
                for f, c, p, v in zip(*(b.column(x).to_pylist() for x in "fcp"), b.column("v")):
                    if (f, c) != now:
                        now, pieces, model = (f, c), [], None
                    if p < 0:
                        pieces.append(v.as_py())
                        continue
                    if model is None:
                        model, pieces = Model(*merged(pieces), top, BYTE), []
                    found = packed_floats(model.ask(unpacked_numbers(v.as_py())))
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([f], pa.int64()), pa.array([found], pa.binary())], names=["p", "f", "v"])

        every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))) if copies > 1 else F.lit(0)
        held = self.pieces.select(F.lit(-1).cast("long").alias("p"), "f", "v", every.alias("c"))
        both = held.unionByName(asked.withColumn("c", F.pmod(F.xxhash64("p"), F.lit(copies)).cast("int")))
        return both.repartition(fragments * copies, "f", "c").sortWithinPartitions("f", "c", "p").mapInArrow(run, "p long, f long, v binary")


def merged(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(grams, counts) of packed pieces, which share none."""
    if not pieces:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*(unpacked_numbers(v, True) for v in pieces)))


def by_fragment(batches):
    """(f, pieces) of rows (f, v) in order of f."""
    now, pieces = None, []
    for b in batches:
        for f, v in zip(b.column("f").to_pylist(), b.column("v").to_pylist()):
            if f != now and pieces:
                yield now, pieces
                pieces = []
            now = f
            pieces.append(v)
    if pieces:
        yield now, pieces


# ---------------------------------------------------------------- the base line's words


class WordPart:
    """The words of some texts: the distinct ones have a ``place`` each, ascending by fragment, and ``ends``
    of each fragment's; ``index`` leads every word to its own."""

    def __init__(self, w: Words, fragments: int):
        distinct, index = distinct_of(w.hash)
        order = np.argsort(distinct)
        rank = np.empty(len(distinct), np.int64)
        rank[order] = np.arange(len(distinct))
        self.index = rank[index]
        f, self.place = _split48(distinct[order], fragments)
        self.ends = np.cumsum(np.bincount(f, minlength=fragments))


def packed_numbers_of(values: np.ndarray) -> bytes:
    """Numbers over 0 in any order, as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked_numbers_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def _split48(h: np.ndarray, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, 48-bit place in it) of ascending hashes; ascending."""
    f, low = np.uint64(fragments), np.uint64(32)
    rest = (h & np.uint64(0xFFFFFFFF)) * f
    placed = (h >> low) * f + (rest >> low)
    return (placed >> low).astype(np.int64), ((placed & np.uint64(0xFFFFFFFF)) << np.uint64(16)) | ((rest & np.uint64(0xFFFFFFFF)) >> np.uint64(16))


def _pack(place: np.ndarray, rows: np.ndarray, times: np.ndarray, ids: np.ndarray, train: np.ndarray) -> bytes:
    """Postings of one fragment: ascending places, the row and count of each, the rows' ids."""
    used, index = np.unique(rows, return_inverse=True)
    steps = np.diff(place, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T[:6]
    index = index.astype("<u2" if len(used) <= 1 << 16 else "<u4")
    head = np.array([len(place), len(used), index.itemsize], "<i8").tobytes()
    raw = head + steps.tobytes() + index.tobytes() + times.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() + ids[used].tobytes() + train[used].astype(np.uint8).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(raw: bytes):
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n, k, width = (int(x) for x in np.frombuffer(raw, "<i8", 3))
    at = 24
    steps = np.zeros((8, n), np.uint8)
    steps[:6] = np.frombuffer(raw, np.uint8, 6 * n, at).reshape(6, n)
    at += 6 * n
    index = np.frombuffer(raw, f"<u{width}", n, at)
    at += width * n
    times = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T.copy().view("<u4").ravel()
    at += 4 * n
    ids, train = np.frombuffer(raw, np.int64, k, at), np.frombuffer(raw, np.uint8, k, at + 8 * k)
    return np.cumsum(steps.T.copy().view("<u8").ravel(), dtype=np.uint64), ids[index], times.astype(np.int64), train[index].astype(bool)


class Scoring:
    """The passes over one table of documents."""

    def __init__(self, docs: DataFrame, *, key: str, text: str, held_out: str):
        fold = F.expr(held_out.format(key=f"coalesce(CAST(`{key}` AS STRING), '')"))
        self.key = key
        self.rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"), fold.alias("h"))

    def run(self) -> DataFrame:
        counts = materialize(self.counted(), "counts")
        trees = Trees(counts.groupBy("g").agg(F.sum("n").alias("n")))
        parts = materialize(self.parted(), "parts")
        n_parts, size = parts.agg(F.count(F.lit(1)), F.sum(F.aggregate("o", F.lit(0).cast("long"), lambda s, x: s + x))).first()
        fragments = max(1, math.ceil((size or 0) / FRAGMENT))
        words = materialize(self.counted_words(parts, fragments), "words")
        tokens, texts, distinct = (words.where(f"kind = {x}").agg(F.sum("n")).first()[0] or 0 for x in (2, 3, 1))
        distinct += texts > 0
        total = tokens + texts
        unit = math.log10(total + 0.5 * (distinct + 1))
        answers = trees.answered(self.asked(parts, trees), n_parts)
        answers = answers.unionByName(words.where("kind = 0").select("p", (F.col("f") + trees.fragments).alias("f"), "v"))
        return self.scored(parts, answers, trees.fragments, fragments, texts).select(
            F.col("k").alias(self.key),
            F.col("h").alias("held_out"),
            F.col("tokens").alias("n_tokens"),
            F.col("known").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") - F.col("tokens") * F.lit(unit)).alias("base_score"),
            "score",
            (-F.col("score") * F.lit(math.log2(10)) / F.greatest("bytes", F.lit(1))).alias("bits_per_byte"),
        )

    def counted(self) -> DataFrame:
        """(g, n): byte grams of training texts.  A task passes them on in parts of a bounded size, so
        a gram may come several times."""

        def run(batches):
            merged, waiting, size = (np.empty(0, np.int64), np.empty(0, np.int64)), [], 0

            def together():
                g = np.concatenate([x for x, _ in waiting])
                order = np.argsort(g, kind="stable")  # sorted runs, which this merges
                start = _starts(g[order])
                return g[order][start], np.add.reduceat(np.concatenate([x for _, x in waiting])[order], start) if len(g) else g

            def batch():
                return pa.RecordBatch.from_arrays([pa.array(merged[0]), pa.array(merged[1])], names=["g", "n"])

            for part in text_parts(batches, "t", PART):
                waiting.append(grams(part.column("t").filter(pc.invert(part.column("h")))))
                size += len(waiting[-1][0])
                if size >= max(1 << 20, len(merged[0])):  # merges double what they merge, so that each gram is sorted a few times
                    waiting.append(merged)
                    merged, waiting, size = together(), [], 0
                    if len(merged[0]) >= HELD_GRAMS:
                        yield batch()
                        merged = np.empty(0, np.int64), np.empty(0, np.int64)
            waiting.append(merged)
            merged = together()
            if len(merged[0]):
                yield batch()

        return self.rows.mapInArrow(run, "g long, n long")

    def counted_words(self, parts: DataFrame, fragments: int) -> DataFrame:
        """kind 0: (p, f, v), the training counts of the words of a part in one fragment; 1: the
        number of distinct training words; 2: training words; 3: training texts."""

        def cut(batches):
            words, texts = 0, 0
            for b in batches:
                for i, p in enumerate(b.column("p").to_pylist()):
                    w = Words(unpacked_texts(b.column("t")[i].as_py(), b.column("o")[i].values))
                    train = ~b.column("h")[i].values.to_numpy(zero_copy_only=False)
                    part = WordPart(w, fragments)
                    taught = np.repeat(train, np.diff(w.first))
                    words += int(taught.sum())
                    texts += int(train.sum())
                    times = np.bincount(part.index, weights=taught, minlength=len(part.place)).astype(np.int64)
                    start = np.concatenate(([0], part.ends[:-1]))
                    some = np.flatnonzero(part.ends > start).tolist()
                    one, yes = np.array([p]), np.array([True])
                    packed = [_pack(part.place[start[f] : part.ends[f]], np.zeros(part.ends[f] - start[f], np.int64), times[start[f] : part.ends[f]], one, yes) for f in some]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(packed, pa.binary())], names=["f", "p"])
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([np.array([words, texts]).tobytes()], pa.binary())], names=["f", "p"])

        def batch(kind, n, p=None, f=None, v=None):
            cols = [pa.array([kind], pa.int32()), pa.array([n], pa.int64()), pa.array([p], pa.int64()), pa.array([f], pa.int64()), pa.array([v], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["kind", "n", "p", "f", "v"])

        def count(batches):
            packed: dict[int, list[bytes]] = {}
            for b in batches:
                for f, p in zip(b.column("f").to_pylist(), b.column("p").to_pylist()):
                    if f >= 0:
                        packed.setdefault(f, []).append(p)
                    else:
                        words, texts = np.frombuffer(p, np.int64)
                        yield batch(2, int(words))
                        yield batch(3, int(texts))
            for f in sorted(packed):  # one at a time: a task may have drawn several
                found = [_unpack(p) for p in packed.pop(f)]
                places, at = distinct_of(np.concatenate([x[0] for x in found]))
                c = np.bincount(at, weights=np.concatenate([x[2] for x in found]), minlength=len(places)).astype(np.int64)
                yield batch(1, int((c > 0).sum()))
                ends = np.cumsum([len(x[0]) for x in found])
                for x, y, z in zip(found, ends - [len(x[0]) for x in found], ends):
                    yield batch(0, 0, int(x[1][0]), f, packed_numbers_of(c[at[y:z]]))

        cuts = parts.select("p", "h", "o", "t").mapInArrow(cut, "f long, p binary")
        return cuts.repartition(fragments, "f").mapInArrow(count, "kind int, n long, p long, f long, v binary")

    def parted(self) -> DataFrame:
        """One row for some rows with about ASKED bytes of text: a number p, lists of their keys, folds and text
        lengths, and the texts compressed."""

        def run(batches):
            p = TaskContext.get().partitionId() << 32
            for part in text_parts(batches, "t", ASKED):
                ends = pa.array([0, part.num_rows], pa.int32())
                t, lengths = packed_texts(part.column("t"))
                lists = [pa.ListArray.from_arrays(ends, x) for x in (part.column("k"), part.column("h"), lengths)]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), *lists, pa.array([t], pa.binary())], names=["p", "k", "h", "o", "t"])
                p += 1

        return self.rows.mapInArrow(run, "p long, k array<long>, h array<boolean>, o array<long>, t binary")

    def asked(self, parts: DataFrame, trees: Trees) -> DataFrame:
        fragments = trees.fragments

        def run(batches):
            for b in batches:
                for i, p in enumerate(b.column("p").to_pylist()):
                    part = Part(unpacked_texts(b.column("t")[i].as_py(), b.column("o")[i].values), fragments)
                    start = np.concatenate(([0], part.ends[:-1]))
                    some = np.flatnonzero(part.ends > start)
                    v = [packed_numbers(part.distinct[start[f] : part.ends[f]]) for f in some.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), p, np.int64)), pa.array(some), pa.array(v, pa.binary())], names=["p", "f", "v"])

        return parts.select("p", "o", "t").mapInArrow(run, "p long, f long, v binary")

    def scored(self, parts: DataFrame, answers: DataFrame, trees: int, fragments: int, texts: int) -> DataFrame:
        """The rows of the parts with their scores; the answers to a part come before it: those of
        the trees' fragments, then those of the words'."""
        stop, stop_seen = math.log10(texts + 0.5), int(texts > 0)

        def run(batches):
            held, counts = [], []
            for b in batches:
                for i, f in enumerate(b.column("f").to_pylist()):
                    if f < trees:
                        held.append(unpacked_floats(b.column("v")[i].as_py()))
                    elif f < trees + fragments:
                        counts.append(unpacked_numbers_of(b.column("v")[i].as_py()))
                    else:
                        texts = unpacked_texts(b.column("t")[i].as_py(), b.column("o")[i].values)
                        log = Part(texts, trees).scores(np.concatenate(held) if held else np.empty(0))
                        yield rows(b.column("k")[i].values, b.column("h")[i].values, texts, log, np.concatenate(counts) if counts else np.empty(0, np.int64))
                        held, counts = [], []

        def rows(keys, folds, texts, log, counts):
            w = Words(texts)
            n, index = len(w.first) - 1, WordPart(w, fragments).index
            text = np.repeat(np.arange(n), np.diff(w.first))
            known = np.bincount(text, weights=(counts > 0)[index], minlength=n).astype(np.int64) + stop_seen
            base = np.bincount(text, weights=np.log10(counts + 0.5)[index], minlength=n) + stop
            return pa.RecordBatch.from_arrays(
                [keys, folds, pa.array(np.diff(w.first) + 1, pa.int64()), pa.array(known), pa.array(base), pa.array(log), pa.array(np.diff(w.offsets), pa.int64())],
                names=["k", "h", "tokens", "known", "base", "score", "bytes"],
            )

        both = answers.unionByName(parts.withColumn("f", F.lit(trees + fragments).cast("long")), allowMissingColumns=True)
        ordered = both.repartition("p").sortWithinPartitions("p", "f")
        return ordered.mapInArrow(run, "k long, h boolean, tokens long, known long, base double, score double, bytes long")


def score_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", held_out: str = "crc32(CAST({key} AS BINARY)) % 5 = 1") -> DataFrame:
    """One row per row of ``docs``: key (an integer), held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte.

    ``held_out`` is SQL over the key as text; the other rows train.  Null texts are empty ones: the end is their one token.
    A null key counts as empty text.  Repeated rows train as often as they occur.  Without training rows the
    base line has N = V = 0 and the model codes every symbol alike.  An empty table gives no rows; other columns are ignored.
    """
    return Scoring(docs, key=key, text=text, held_out=held_out).run()
