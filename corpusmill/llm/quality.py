"""Compression classifier: zstandard dictionaries built from good and bad labelled text.

A text is cut into blocks, every block is compressed with either dictionary, and the
difference of the sizes over the text's bytes, by the two calibrated coefficients, is the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_parts

BLOCK = 2048


def build_dictionary(texts: list[bytes], size: int, block: int = BLOCK) -> bytes:
    """A zstandard dictionary of the texts' blocks; their plain bytes where too few to train."""
    samples = [t[i : i + block] for t in texts for i in range(0, len(t), block)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class Model:
    """Two dictionaries and a logistic curve over the features of ``measure``."""

    def __init__(self, good: bytes, bad: bytes, level: int = 3, curve: tuple[float, ...] = (0.0, 1.0, 0.0)):
        self.good, self.bad, self.level, self.curve = good, bad, level, curve
        self._with = None

    def __getstate__(self):
        return {**self.__dict__, "_with": None}

    def measure(self, text: bytes) -> tuple[float, float]:
        """The normalised size difference of the whole text (positive: the good dictionary fits
        better) and that of the block that fits the bad one best."""
        if self._with is None:
            self._with = []
            for raw in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(raw) if raw else None
                if d is not None:
                    d.precompute_compress(level=self.level)
                self._with.append(zstandard.ZstdCompressor(level=self.level, dict_data=d, write_content_size=False, write_dict_id=False) if d is not None else zstandard.ZstdCompressor(level=self.level))
        good, bad = self._with
        total, worst = 0, 0.0
        for i in range(0, len(text), BLOCK):
            part = text[i : i + BLOCK]
            gain = len(bad.compress(part)) - len(good.compress(part))
            total += gain
            worst = min(worst, gain / max(len(part), BLOCK // 4))
        return total / max(len(text), BLOCK // 4), worst

    def score(self, text: bytes) -> float:
        a, b, c = self.curve
        whole, worst = self.measure(text)
        return 1.0 / (1.0 + float(np.exp(-np.clip(a + b * whole + c * worst, -50, 50))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-6, steps: int = 60) -> np.ndarray:
    """Weighted logistic regression with an intercept, by damped Newton steps."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    a = np.hstack([np.ones((len(x), 1)), x / scale])
    beta = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        s = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((a * s[:, None]).T @ a + ridge * len(x) * np.eye(len(beta)), a.T @ (weight * (y - p)) - ridge * len(x) * beta)
        beta += np.clip(step, -5, 5)
    return np.concatenate([beta[:1], beta[1:] / scale])


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", key: str = "doc_id", text: str = "text", fold: str = "crc32(CAST(CAST({key} AS STRING) AS BINARY)) % 3 != 1",
    per_class: int = 1200, max_text_bytes: int = 1 << 16, dictionary_bytes: int = 65536, level: int = 3,
) -> Model:
    """A model of the labelled rows in ``fold``.

    It reads a bounded sample: of either label the ``per_class`` rows with the smallest key
    hash, and of those the texts of up to ``max_text_bytes``.  Two thirds build the
    dictionaries, one third and the class shares of all labels in the fold calibrate the curve.
    Rows with a null label, key or text and keys with both labels teach nothing.  A key that
    stands for several texts teaches by the one with the smallest md5, so that the model is the same in
    every run; repeated rows and labels count once.  Without rows of either label, as with
    empty tables, the score is the share of label 1 (a half if there are none).  Ties of the key's
    hash go by key; other columns are ignored.
    """
    usable = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where(F.expr(fold.format(key="k")) & F.col("k").isNotNull() & F.col("y").isin(0, 1))
    usable = usable.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("k", "y")
    share = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y in (0, 1):
        part = usable.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(per_class)
        picked = part if picked is None else picked.union(part)
    body = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull() & (F.octet_length("t") <= max_text_bytes))
    met = body.join(F.broadcast(picked), "k").select("k", "y", F.col("t").cast("binary").alias("t"))
    rows = met.groupBy("k", "y").agg(F.min_by("t", F.struct(F.md5("t"), "t")).alias("t")).collect()
    rows = sorted(((r["k"], r["y"], bytes(r["t"])) for r in rows), key=lambda r: (r[1], r[0]))
    prior = {y: share.get(y, 0) for y in (0, 1)}
    by = {y: [r[2] for r in rows if r[1] == y] for y in (0, 1)}
    if not by[0] or not by[1]:
        odds = (prior[1] + 0.5) / (prior[0] + 0.5) if prior[0] != prior[1] else 1.0
        return Model(b"", b"", level, (float(np.log(odds)), 0.0, 0.0))
    train = {y: [t for i, t in enumerate(by[y]) if i % 3 != 2 or len(by[y]) < 3] for y in (0, 1)}
    held = {y: [t for i, t in enumerate(by[y]) if i % 3 == 2 or len(by[y]) < 3] for y in (0, 1)}
    model = Model(build_dictionary(train[1], dictionary_bytes), build_dictionary(train[0], dictionary_bytes), level)
    x = np.array([model.measure(t) for y in (0, 1) for t in held[y]])
    y = np.array([float(v) for v in (0, 1) for _ in held[v]])
    n = prior[0] + prior[1]
    weight = np.array([prior[int(v)] / n / len(held[int(v)]) for v in y]) * len(y)
    model.curve = tuple(float(v) for v in logistic(x, y, weight))
    return model


def score_quality(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: key, score, predicted.

    Null texts score as empty ones, texts of any length whole, block by block; equal texts score the
    same.  A null key stays null, repeated rows give repeated results, an empty table none; other
    columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in text_parts(batches, "t"):
            scores = np.array([sent.value.score(t) for t in part.column("t").cast(pa.large_binary()).fill_null(b"").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))], names=[key, "score", "predicted"])

    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"`{key}` {kind}, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns.

    Only the text decides, as in ``score_quality``: null texts go by the score of an empty one,
    repeated rows stay or go together, null keys play no part, an empty table stays empty.
    """
    names = docs.columns
    at = names.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in text_parts(batches, text):
            texts = part.column(at).cast(pa.large_binary()).fill_null(b"").to_pylist()
            yield part.filter(pa.array([sent.value.score(t) >= threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
