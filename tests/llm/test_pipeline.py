import math

import corpus_pipeline
from corpusmill.llm import quality
from corpusmill.llm.queries import ORACLES, QUERIES

from .common import docs, sample, shingles
from .test_jaccard import brute as components
from .test_native import place

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs_ = sample(spark)
    text = {r["doc_id"]: r["text"] for r in docs_.collect()}
    model = quality.fit(docs_, sample(spark, "labels"))
    kept = {i for i, t in text.items() if model.score(t.encode()) >= 0.5}
    group = components([(i, text[i]) for i in kept])
    kept = {i for i in kept if group[i][1] == i}
    items = [shingles(r["text"]) for r in sample(spark, "benchmark").collect()]
    kept = {i for i in kept if not any(s and len(s & shingles(text[i])) >= math.ceil(0.8 * len(s)) for s in items)}
    stage = docs_
    for _, f in corpus_pipeline.STAGES[:3]:
        stage = f(spark, stage, SF)
        assert stage.columns == docs_.columns
    assert {r["doc_id"] for r in stage.collect()} == kept and 0 < len(kept) < len(text)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} <= kept and out
    assert all(r["shard"] == place(r["doc_id"], dict.fromkeys(range(40), 1.0)) for r in out)


def test_stages_take_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "some words stand here"), (3, None)]
    for x in (docs(spark, rows), docs(spark, [])):
        for _, f in corpus_pipeline.STAGES:
            assert f(spark, x, SF).count() <= 5


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


def test_each_stage_on_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    item = sample(spark, "benchmark").first()["text"]
    long = " ".join(f"v{i % 5000}x{i}" for i in range(150_000))
    rows = [(1, passage), (1, passage), (2, passage + " end"), (3, None), (4, ""), (4, ""), (5, long), (6, long + " tail"), (None, passage), (7, f"{long} {item}"), (8, "tie one"), (9, "tie two")]
    df = docs(spark, rows)
    ids = lambda x: sorted((r["doc_id"] or -1) for r in x.collect())
    stage = dict(corpus_pipeline.STAGES)
    model = quality.fit(df, sample(spark, "labels"))
    good = stage["quality classifier"](spark, df, SF)
    assert ids(good) == sorted((i or -1) for i, t in rows if model.score((t or "").encode()) >= 0.5) and good.columns == df.columns
    one = stage["n-gram Jaccard join"](spark, df, SF)
    assert ids(one) == [-1, 1, 3, 4, 4, 5, 8, 9] and one.columns == df.columns
    clean = stage["benchmark decontamination"](spark, df, SF)
    assert ids(clean) == sorted((i or -1) for i, _ in rows if i != 7) and clean.columns == df.columns
    mixed = stage["mixing to target weights"](spark, df, SF)
    counts = {i: ids(mixed).count(i) for i in (1, 4)}
    assert counts[1] % 2 == 0 and counts[4] in (0, 2) and set(ids(mixed)) <= set(ids(df)) and mixed.columns == df.columns
    sharded = stage["sharding"](spark, df, SF).collect()
    assert all(r["shard"] == place("\0" if r["doc_id"] is None else r["doc_id"], dict.fromkeys(range(40), 1.0)) for r in sharded) and len(sharded) == len(rows)
    for _, f in corpus_pipeline.STAGES:
        empty = f(spark, df.limit(0), SF)
        assert empty.count() == 0 and set(df.columns) <= set(empty.columns)


def test_mixing_stage_against_brute_force(spark):
    import hashlib
    import math as m
    from collections import Counter

    rows = [tuple(r) for r in sample(spark).select("doc_id", "text", "lang", "source").collect()]

    def topic(t):
        size = len(t.encode())
        return "table" if " | " in t else "list" if "\n- " in t else "short" if size < 400 else "long" if size >= 8000 else "prose"

    cell = {i: (s, lang, topic(t)) for i, t, lang, s in rows}
    tokens = {i: (len(t.encode()) + 3) // 4 for i, t, *_ in rows}
    held = Counter()
    for i, c in cell.items():
        held[c] += tokens[i]
    total = sum(held.values())
    goals = []
    for d in range(3):
        sums = Counter()
        for c, n in held.items():
            sums[c[d]] += n
        powers = {v: (n / total) ** 0.9 for v, n in sums.items()}
        goals.append({v: p / sum(powers.values()) for v, p in powers.items()})
    w = {c: float(n) for c, n in held.items()}
    for _ in range(8):
        for d in range(3):
            sums = Counter()
            for c, x in w.items():
                sums[c[d]] += x
            w = {c: x * goals[d][c[d]] / sums[c[d]] for c, x in w.items()}
    scale = total / sum(w.values())
    want = Counter()
    for i, c in cell.items():
        p = w[c] / held[c] * scale
        draw = int(hashlib.md5(f"7:{i}".encode()).hexdigest()[:13], 16) / 2**52
        want[i] += m.floor(p) + (draw < p - m.floor(p))
    got = Counter(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["mixing to target weights"](spark, sample(spark), SF).collect())
    assert got == Counter({i: n for i, n in want.items() if n})
