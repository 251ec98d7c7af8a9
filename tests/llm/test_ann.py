import numpy as np
import pytest

from corpusmill.llm.ann import nearest

from .common import sample

SCHEMA = "vec_id long, embedding array<float>, k string, score double"


def brute(ids, x, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_recall_against_brute_force(spark):
    df = sample(spark, "embeddings", "sf0.1")
    rows = df.select("vec_id", "embedding").collect()
    want = brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64), 20, 10)
    hit, scores = 0, {}
    for r in nearest(df, every=20).collect():
        scores.setdefault(r["query_id"], []).append(r["rank"])
        exact = dict(want[r["query_id"]])
        if r["vec_id"] in exact:
            hit += 1
            assert r["score"] == pytest.approx(exact[r["vec_id"]], abs=1e-12)
    assert all(sorted(v) == list(range(1, 11)) for v in scores.values()) and set(scores) == set(want)
    assert hit / sum(map(len, want.values())) >= 0.9


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [0.0, 1.0]), (None, [1.0, 1.0]), (8, [float("inf"), 0.0]), (2, [1.0, 0.0]), (100, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", 0.0) for r in rows], SCHEMA)
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(df, every=100).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 7)]


def test_no_rows(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0], "x", 0.0)], SCHEMA)).count() == 0


def test_recall_with_a_very_common_vector(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 64))
    x[rng.random(3000) < 0.4] = x[0]
    x[5::50] = x[0] + 0.3 * rng.normal(size=x[5::50].shape)
    ids = np.arange(3000)
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<double>")
    want = brute(ids, x, 25, 10)
    got = [(r["query_id"], r["vec_id"]) for r in nearest(df, every=25).collect()]
    assert sum(v in dict(want[q]) for q, v in got) >= 0.9 * len(got) == 0.9 * 1200


def test_crowded_files_and_many_queries_in_parts(spark, monkeypatch):
    from corpusmill.llm import ann

    for name, size in (("CROWD", 100), ("CHUNK", 64), ("BLOCK", 7), ("QUERIES", 20)):
        monkeypatch.setattr(ann, name, size)
    df = sample(spark, "embeddings", "sf0.001")
    rows = df.select("vec_id", "embedding").collect()
    want = brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64), 5, 10)
    got = nearest(df, every=5).collect()
    assert sum(r["vec_id"] in dict(want[r["query_id"]]) for r in got) >= 0.9 * sum(map(len, want.values()))
    assert {len([r for r in got if r["query_id"] == q]) for q in want} == {10}


def test_visited_rows_grow_slower_than_rows(spark):
    rng = np.random.default_rng(2)
    shares = []
    for n in (2000, 16000):
        x = rng.normal(size=(n, 32)) + 3 * rng.normal(size=(40, 32))[np.arange(n) % 40]
        df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
        got = nearest(df, every=200).collect()
        want = brute(np.arange(n), x, 200, 10)
        assert sum(r["vec_id"] in dict(want[r["query_id"]]) for r in got) >= 0.9 * sum(map(len, want.values()))
        shares.append(np.mean([r["visited"] for r in got]) / n)
    assert shares[1] < 0.7 * shares[0] < 0.7


def test_lengths_are_apart(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0, 0.0]), (3, [0.0, 0.0, 1.0]), (200, [5.0])]
    got = [(r["query_id"], r["vec_id"]) for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    assert sorted(got) == [(0, 1), (100, 3)]
