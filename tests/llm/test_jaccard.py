import random

import numpy as np

from corpusmill.llm import jaccard

from .common import docs, sample, shingles


def brute(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def run(spark, rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(docs(spark, rows)).collect()}


def near_copies(n, seed, alterations):
    r = random.Random(seed)
    base = [f"b{r.randrange(10**6)}" for _ in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.choice(alterations)):
            w[r.randrange(len(w))] = f"z{r.randrange(12)}"
        cut = r.choice([0, 0, 0, 20, 32])
        out.append((seed * 1000 + i, " ".join(w[: len(w) - cut])))
    return out


def test_groups_of_near_copies_and_chains(spark):
    rows = near_copies(60, 1, [0, 1, 2, 3, 4, 5]) + near_copies(40, 2, [2, 3, 4]) + near_copies(40, 3, [1, 3])
    chain = [f"c{i}" for i in range(200)]
    rows += [(9000 + i, " ".join(chain[i * 8 : i * 8 + 80])) for i in range(15)]
    rows += [(9100, "a b"), (9101, "A  b"), (9102, "a b c")]
    assert run(spark, rows) == brute(rows)


def test_without_hubs_only_the_fragments_link(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = near_copies(30, 4, [0, 1, 2, 3, 4]) + near_copies(30, 5, [3])
    monkeypatch.setattr(jaccard.Join, "stars", lambda self, segments: segments.select(F.col("k").alias("a"), F.col("k").alias("b")).limit(0))
    assert run(spark, rows) == brute(rows)


def test_sample(spark):
    rows = [tuple(r) for r in sample(spark).select("doc_id", "text").collect()]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (3, text + " end"), (1, None), (2, ""), (4, " \n "), (None, text), (8, "one two three"), (8, "other words here now and more"), (9, "x " * 200_000)]
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 36, 3), (5, 36, 3), (3, 37, 3), (1, 0, 1), (2, 0, 2), (4, 0, 4), (-1, 36, None), (8, 1, 8), (8, 2, 8), (9, 1, 9)], key=str)
    kept = jaccard.one_of_each(docs(spark, rows))
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 8, 8, 9] and kept.columns == docs(spark, rows).columns
    assert jaccard.similar_components(docs(spark, [])).count() == 0


def brute_links(rows, percent=80):
    sets = [(i, shingles(t)) for i, t in rows]
    out = []
    for x, (i, a) in enumerate(sets):
        n, same = 0, [i]
        for y, (j, b) in enumerate(sets):
            if x != y and a and b and i is not None and j is not None:
                both = len(a & b)
                n += 100 * both >= percent * (len(a) + len(b) - both)
                same += [j] * (a == b)
        out.append((i, None if i is None else min(same), n))
    return sorted(out, key=str)


def counted(spark, rows):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.similar_links(docs(spark, rows)).collect()), key=str)


def test_links_inside_components_are_counted(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(40))
    rows = near_copies(60, 1, [0, 1, 2, 3, 4, 5]) + near_copies(40, 2, [0, 2, 3]) + [(9300, text), (9300, text), (9200, text + " end"), (None, text), (9401, None), (9402, "")]
    chain = [f"c{i}" for i in range(200)]
    rows += [(9000 + i, " ".join(chain[i * 8 : i * 8 + 80])) for i in range(15)]
    want = brute_links(rows)
    assert counted(spark, rows) == want and max(x[2] for x in want) > 20
    monkeypatch.setattr(jaccard, "ROWS", 7)
    monkeypatch.setattr(jaccard, "GRAMS", 600)
    assert counted(spark, rows) == want
    found = jaccard.similar_links(docs(spark, rows))
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(r["doc_id"], r["component_id"]) for r in jaccard.similar_components(docs(spark, rows)).collect()}


def test_no_links_to_count(spark):
    assert counted(spark, [(1, "a b c"), (2, "d e"), (2, "d e"), (3, None)]) == [(1, 1, 0), (2, 2, 1), (2, 2, 1), (3, 3, 0)]
    assert jaccard.similar_links(docs(spark, [])).count() == 0


def test_one_of_each_leaves_one_of_repeated_rows(spark):
    text, other = " ".join(f"w{i}" for i in range(40)), "other words here now and more of them still"
    rows = [(1, text), (1, text), (2, text), (8, "one two three"), (8, "one two three"), (8, other), (8, other + " end"), (9, other), (None, text), (None, text), (3, ""), (3, "")]
    kept = sorted(((r["doc_id"] or -1, r["text"]) for r in jaccard.one_of_each(docs(spark, rows)).collect()), key=str)
    assert len(kept) == 7 and kept.count((1, text)) == 1 and kept.count((8, "one two three")) == 1 and kept.count((-1, text)) == 2 and kept.count((3, "")) == 2
    assert sum(t.startswith(other) for _, t in kept) == 1
    again = jaccard.one_of_each(docs(spark, [(i, t) for i, t in kept if i > 0]))
    assert again.count() == 5
    assert jaccard.one_of_each(docs(spark, [])).count() == 0


def test_frequent_ngrams_in_many_batches(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FRAGMENT", 400)
    monkeypatch.setattr(jaccard, "PART", 2000)
    monkeypatch.setattr(jaccard, "CLASSES", 40)
    monkeypatch.setattr(jaccard, "SUMS", 50)
    shared = " ".join(f"s{i}" for i in range(30))
    rows = near_copies(60, 6, [0, 1, 2, 4]) + [(50_000 + i, shared + " " + " ".join(f"o{i}x{j}" for j in range(r))) for i, r in enumerate([3, 4, 5, 6, 20, 40] * 5)]
    rows += [(60_000 + i, t) for i, (_, t) in enumerate(rows[:40])]
    assert run(spark, rows) == brute(rows)


def test_postings_come_back_as_packed():
    rng = np.random.default_rng(5)
    for n, owners in ((0, 1), (1, 1), (300, 290), (5000, 200), (5000, 4000), (80000, 70000)):
        places = np.sort(rng.integers(0, 1 << 32, n, dtype=np.uint64))
        ids = rng.integers(-(1 << 63), (1 << 63) - 1, owners)[rng.integers(0, owners, n)]
        raw = jaccard._pack(places, ids)
        assert jaccard._length(raw) == n
        assert all(np.array_equal(x, y) for x, y in zip(jaccard._unpack(raw), (places, ids)))
