import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import ctw

from .common import docs, sample, words


def model_of(texts):
    g, n = ctw.grams(pa.array(texts))
    symbol_of = np.full(256, ctw.ESCAPE, np.int64)
    for i, b in enumerate(sorted({int(x) & 255 for x in g} - {ctw.STOP})):
        symbol_of[b] = 3 + i
    symbol_of[ctw.PAD], symbol_of[ctw.STOP] = ctw.START, ctw.END
    out = {}
    for x, c in zip(g.tolist(), n.tolist()):
        w = 0
        for d in range(ctw.DEPTH, -1, -1):
            w = w * 64 + int(symbol_of[x >> 8 * d & 255])
        out[w] = out.get(w, 0) + c
    return out, ctw.Model(np.array(list(out)), np.array(list(out.values())))


def predicted(grams, context, level, prefix, d=0):
    """The textbook recursion: weight of the own KT estimate, the rest to the longer context."""

    def counts(c, depth):
        n = [0, 0]
        for w, k in grams.items():
            if (w >> 6) % 64**depth == c and (w & 63) >> (6 - level) == prefix:
                n[w >> (5 - level) & 1] += k
        return n

    def block(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    def weighted(c, depth):
        own = block(*counts(c, depth))
        if depth == ctw.DEPTH:
            return own
        below = {(w >> 6) % 64 ** (depth + 1) for w in grams if (w >> 6) % 64**depth == c}
        return math.log(0.5) + np.logaddexp(own, sum(weighted(x, depth + 1) for x in below))

    c = context % 64**d
    z, o = counts(c, d)
    if z + o == 0:
        return 0.5
    kt = (o + 0.5) / (z + o + 1)
    if d == ctw.DEPTH:
        return kt
    own = math.exp(math.log(0.5) + block(z, o) - weighted(c, d))
    return own * kt + (1 - own) * predicted(grams, context, level, prefix, d + 1)


def test_model_is_the_textbook_mixture_and_adds_up_to_one():
    grams, model = model_of(["abra cadabra", "abrab", ""])
    contexts = [list(grams)[3] >> 6, list(grams)[7] >> 6, (list(grams)[5] >> 6) ^ (7 << 24), 12345]
    for context in contexts:
        g = np.array([context * 64 + s for s in range(64)])
        at = model.places(g)
        logp = np.where(at >= 0, model.logp[at], 0.0)
        logp[at < 0] = model.unseen(g[at < 0])
        assert (10**logp).sum() == pytest.approx(1, abs=1e-5)
        for s in (1, 4, 9, 40):
            want = sum(math.log10(p if s >> (5 - lv) & 1 else 1 - p) for lv in range(6) for p in [predicted(grams, context, lv, s >> (6 - lv))])
            assert logp[s] == pytest.approx(want, abs=1e-5)


def test_fragments_predict_as_the_whole_model():
    grams, model = model_of(["abra cadabra", "abrab", "", "a cab in a barrel"])
    g, n = np.array(list(grams)), np.array(list(grams.values()))
    f = ctw.fragment_of(g, 5)
    sums = [ctw.top_sums(g[f == x], n[f == x]) for x in range(5)]
    key, zeros, ones, under = (np.concatenate(x) for x in zip(*sums))
    keys, at = np.unique(key, return_inverse=True)
    top = ctw.top_nodes(keys, *(np.bincount(at, weights=x) for x in (zeros, ones, under)))
    ask = np.unique(np.concatenate((g, g ^ 1, g ^ (3 << 30), g ^ (5 << 12), np.arange(200) * 7919 * 64 % 64**6)))
    for x in range(5):
        own = np.sort(ask[ctw.fragment_of(ask, 5) == x])
        assert ctw.Model(g[f == x], n[f == x], top).ask(own) == pytest.approx(model.ask(own), abs=1e-5)


def test_packed_numbers_round_trip():
    g, n = np.array([0, 5, 64**6 - 1]), np.array([1, 2, 2**40])
    assert (ctw.unpacked_numbers(ctw.packed_numbers(g)) == g).all()
    assert [x.tolist() for x in ctw.unpacked_numbers(ctw.packed_numbers(g, n), True)] == [g.tolist(), n.tolist()]
    assert not len(ctw.unpacked_numbers(ctw.packed_numbers(g[:0])))


def test_base_line_against_brute_force(spark):
    rows = [tuple(r) for r in sample(spark).select("doc_id", "text").collect()]
    count, n_docs = collections.Counter(), 0
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(words(t))
            n_docs += 1
    total, unit = sum(count.values()) + n_docs, math.log10(sum(count.values()) + n_docs + 0.5 * (len(count) + 2))
    for r in ctw.score_documents(sample(spark)).collect():
        w = words(dict(rows)[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1, len(w) + 1, total)
        assert r["n_known"] == sum(x in count for x in w) + 1
        assert r["base_score"] == pytest.approx(sum(math.log10(count[x] + 0.5) for x in w) + math.log10(n_docs + 0.5) - (len(w) + 1) * unit, rel=1e-9)
        assert r["score"] < 0


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "Ab ab"), (3, "Ab ab"), (None, "cd"), (4, "x" * 300_000), (5, "\x00é")]
    got = ctw.score_documents(docs(spark, rows)).collect()
    assert len(got) == 7 and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    twins = [r for r in got if r["doc_id"] == 3]
    assert twins[0] == twins[1] and twins[0]["n_tokens"] == 3
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert ctw.score_documents(docs(spark, [])).count() == 0
    assert ctw.score_documents(docs(spark, [(1, "a b")]), held_out="{key} = '1'").first()["train_tokens"] == 0


def test_postings_round_trip():
    h = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    f, place = ctw._split48(h, 7)
    assert (np.diff(f) >= 0).all()
    for x in range(7):
        at = f == x
        rows, ids = np.arange(at.sum()) % 5, np.arange(5) * 11
        got = ctw._unpack(ctw._pack(place[at], rows, np.ones(at.sum(), np.int64), ids, ids > 20))
        assert (got[0] == place[at]).all() and (got[1] == ids[rows]).all() and (got[3] == (ids[rows] > 20)).all()


def test_rare_bytes_have_contexts_of_their_own(spark):
    common = bytes(range(33, 65)) + bytes(range(91, 127))  # more bytes than 61, all more frequent
    rows = [(i, (common * 4).decode()) for i in range(40)] + [(100 + i, "дом кот") for i in range(3)] + [(200, "дом"), (201, "мод")]
    got = {r["doc_id"]: r["score"] for r in ctw.score_documents(docs(spark, rows), held_out="{key} IN ('200', '201')").collect()}
    assert got[200] > got[201] + 3


def test_scores_are_the_whole_models_of_bytes(spark):
    texts = ["abra cadabra", "ein Bär, 87 %", "", "a cab in 中文"]
    g, n = ctw.grams(pa.array(texts))
    model = ctw.Model(g, n, bits=8)
    context = g[5] >> 8
    assert (10 ** model.ask(np.arange(256) + context * 256)).sum() == pytest.approx(1, abs=1e-5)
    asked = [*texts, "Bär 8 文"]
    got = {r["doc_id"]: r["score"] for r in ctw.score_documents(docs(spark, list(enumerate(asked))), held_out="{key} = '4'").collect()}
    for i, t in enumerate(asked):
        own, times = ctw.grams(pa.array([t]))
        assert got[i] == pytest.approx(float((model.ask(own) * times).sum()), abs=1e-4)


def brute_scores(rows, trained):
    """log10 probability of each text by the definition: every node of the trees of all byte prefixes in one table."""
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    coded = {i: bytes([ctw.PAD] * ctw.DEPTH) + (t or "").encode().translate(low) + bytes([ctw.STOP]) for i, t in rows}
    grams = collections.Counter(b[j : j + 6] for i, b in coded.items() if i in trained for j in range(len(b) - 5))
    nodes = collections.defaultdict(lambda: [0, 0])
    for g, n in grams.items():
        for level in range(8):
            prefix, bit = g[5] >> (8 - level), g[5] >> (7 - level) & 1
            for d in range(ctw.DEPTH + 1):
                nodes[g[5 - d : 5], level, prefix][bit] += n
    block = {}

    def own(key):
        z, o = nodes[key]
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    children = collections.defaultdict(float)
    for d in range(ctw.DEPTH, -1, -1):
        for key in [k for k in nodes if len(k[0]) == d]:
            block[key] = own(key) if d == ctw.DEPTH else math.log(0.5) + float(np.logaddexp(own(key), children[key]))
            if d:
                children[key[0][1:], *key[1:]] += block[key]
    seen = {}

    def bit_one(context, level, prefix):
        p, rest = 0.0, 1.0
        for d in range(ctw.DEPTH + 1):
            key = context[5 - d :], level, prefix
            if key not in nodes:
                return p + rest * 0.5
            z, o = nodes[key]
            w = 1.0 if d == ctw.DEPTH else math.exp(math.log(0.5) + own(key) - block[key])
            p, rest = p + rest * w * (o + 0.5) / (z + o + 1), rest * (1 - w)
        return p

    def log_gram(g):
        if g not in seen:
            ones = [(bit_one(g[:5], lv, g[5] >> (8 - lv)), g[5] >> (7 - lv) & 1) for lv in range(8)]
            seen[g] = sum(math.log10(p if b else 1 - p) for p, b in ones)
        return seen[g]

    return {i: sum(log_gram(b[j : j + 6]) for j in range(len(b) - 5)) for i, b in coded.items()}


@pytest.mark.parametrize("small", [False, True])
def test_scores_of_documents_against_brute_force(spark, monkeypatch, small):
    if small:  # many fragments and copies of them
        for name, size in (("MODEL_FRAGMENT", 5000), ("FRAGMENT", 20_000), ("ASKED", 60_000), ("ANSWERED", 2000), ("HELD_GRAMS", 20_000), ("PART", 30_000)):
            monkeypatch.setattr(ctw, name, size)
    rows = [tuple(r) for r in sample(spark).select("doc_id", "text").where("doc_id < 100").collect()] + [(1000, None), (1001, "")]
    trained = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 != 1}
    want = brute_scores(rows, trained)
    got = {r["doc_id"]: r for r in ctw.score_documents(docs(spark, rows)).collect()}
    assert set(got) == set(want)
    for i, t in rows:
        assert got[i]["score"] == pytest.approx(want[i], rel=1e-5, abs=1e-3)
        assert got[i]["bits_per_byte"] == pytest.approx(-want[i] * math.log2(10) / max(1, len((t or "").encode())), rel=1e-5, abs=1e-3)
    count = collections.Counter(x for i, t in rows if i in trained for x in words(t))
    assert all(got[i]["n_known"] == sum(x in count for x in words(t)) + 1 for i, t in rows)
    total = sum(count.values()) + len(trained)
    unit = math.log10(total + 0.5 * (len(count) + 2))
    assert all(got[i]["base_score"] == pytest.approx(sum(math.log10(count[x] + 0.5) - unit for x in words(t)) + math.log10(len(trained) + 0.5) - unit, rel=1e-9) for i, t in rows)
