"""Helpers of the training-data operators: shared storage and vectorised word kernels.

Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes after lower-casing A-Z.  All hashes are
64 bits wide and the same on every machine and in every run.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one of its own in local mode only, which
    goes when Python ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _OWN:
        folder = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _OWN[app] = "file://" + folder
    return _OWN[app]


def written_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables and packages lie."""
    return f"{shared_dir(spark).rstrip('/')}/corpusmill/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{written_dir(spark)}/{uuid.uuid4().hex}/{name}"


def remove_written(spark: SparkSession) -> bool:
    """Delete all that this application's operators have written between their steps.

    Results that haven't been read or written elsewhere yet can't be read any more, so this is for the end of
    a run.  Says whether there was anything.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(written_dir(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: cuts the lineage."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int = 200_000) -> bool:
    """Whether ``df``, a written table of a few numbers a row, has few enough rows to be broadcast."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df``, to be broadcast if it has ``rows`` at most."""
    return F.broadcast(df) if few(df, rows) else df


def on_tasks(df: DataFrame, tasks: int, place: str | Column) -> DataFrame:
    """``df`` over ``tasks`` tasks by the number ``place``, from 0: one number a task, as hashing it wouldn't give."""
    return df.repartitionById(tasks, (F.col(place) if isinstance(place, str) else place).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- Arrow batches


def text_parts(batches, column: str, max_bytes: int = 1 << 20):
    """Slices of the batches with at most ``max_bytes`` of ``column`` each (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def byte_lengths(array) -> np.ndarray:
    offsets, _ = text_buffers(array)
    return np.diff(offsets)


def text_buffers(array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a text or binary array; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    array = array.cast(pa.large_binary())
    n = len(array)
    if not n:
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    _, off, data = array.buffers()
    offsets = np.frombuffer(off, np.int64)[array.offset : array.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


# ---------------------------------------------------------------- hashing

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (shifts and odd factors)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        inverse = pow(int(_BASE), -1, 1 << 64)
        for k, base in enumerate((int(_BASE), inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each range; equal for equal runs wherever they stand."""
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:], dtype=np.uint64)
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _ODD)


class Words:
    """The words of a batch of texts.

    ``low`` lower-cased bytes, ``start`` and ``end`` byte positions of each word, ``first`` the
    index of each text's first word (one more entry at the end), ``hash`` a hash of each word.
    """

    def __init__(self, array):
        self.offsets, data = text_buffers(array)
        self.low = data + np.uint8(32) * ((data >= 65) & (data <= 90)).astype(np.uint8)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        n = len(data)
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        edges = self.offsets[:-1]
        before[edges[edges < n]] = True
        after[edges[edges > 0] - 1] = True
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(after & ~space) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.hash = range_hashes(_BYTE[self.low], self.start, self.end)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(first, hashes): the k-word shingles of each text in order, repeats included.

        A text with 1 to k-1 words has its whole sequence as one; one without words none.
        """
        counts = self.counts
        n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
        first = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=first[1:])
        start = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], n)
        end = start + np.repeat(np.minimum(counts, k), n)
        return first, range_hashes(self.hash, start, end)


def distinct_sorted(first: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """The distinct hashes of each text, ascending."""
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        x = np.sort(hashes[a:b])
        out.append(x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) > 1 else x)
    return out
