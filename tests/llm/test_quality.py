import zlib

import numpy as np

from corpusmill.llm import quality

from .common import docs, sample


def test_held_out_accuracy(spark):
    d, l = sample(spark, sf="sf0.1"), sample(spark, "labels", "sf0.1")
    score = {r["doc_id"]: r["score"] for r in quality.score_quality(d, quality.fit(d, l)).collect()}
    held = [(r["quality"], score[r["doc_id"]]) for r in l.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    y, s = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    assert ((s >= 0.5) == (y == 1)).mean() >= 0.95 and ((s >= 0.5) == (y == 1)).mean() > y.mean() + 0.05
    assert (s[y == 1] >= 0.5).mean() >= 0.97


def test_odd_rows_and_labels(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    rows = [(1, "good text"), (None, None), (2, ""), (3, "x" * 500_000), (3, "x" * 500_000)]
    df = docs(spark, rows)
    model = quality.fit(df, labels, fold="true")
    got = quality.score_quality(df, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["predicted"] for r in got)
    none = quality.fit(df, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(df, none).collect()} == {0.5}
    assert quality.score_quality(docs(spark, []), model).count() == 0


def test_model_survives_pickling():
    import pickle

    model = quality.Model(b"good words here " * 30, b"BAD!! BAD!! " * 30, 3, (0.0, 50.0, 0.0))
    again = pickle.loads(pickle.dumps(model))
    assert again.score(b"BAD!! BAD!! BAD!!") == model.score(b"BAD!! BAD!! BAD!!") < 0.5 < model.score(b"good words here good")
