"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are split at safe boundaries, where the tokenizer always begins a new pre-token, so that the
pieces' counts add up: before every run of white space that follows something else, if the
tokenizer pre-tokenizes at byte level.  Of equal pieces in a batch one is encoded, in groups
balanced by UTF-8 bytes.  Texts with white space beyond ASCII, and those of other tokenizers, are encoded in
long parts that begin at a single space or behind full-width punctuation.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import byte_lengths, text_buffers, text_parts

_LETTERS = "\u3041-\u3096\u30a1-\u30fa\u3400-\u4db5\u4e00-\u9fa5\uac00-\ud7a3"
_SAFE = re.compile(rf"(?<=[A-Za-z0-9.,]) (?=[A-Za-z0-9])|(?<=[^\W\d_]) (?=[^\W\d_])|(?<=[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])(?=[{_LETTERS}])")
#: First and second bytes of white space beyond ASCII in UTF-8.
_WIDE = np.zeros(1 << 16, bool)
_WIDE[[0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380]] = True
#: Pieces whose counts a worker remembers, and bytes of a piece that it remembers at most.
REMEMBERED, REMEMBERED_BYTES = 400_000, 64
_LOADED: dict[int, object] = {}
_COUNTS: dict[int, dict[bytes, int]] = {}


def pieces(text: str, size: int):
    """Parts of ``text`` of about ``size`` characters, cut only where the tokenizer cuts too."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _loaded(definition: str):
    key = hash(definition)
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED[key] = tokenizer
    return _LOADED[key]


def by_words(tokenizer) -> bool:
    """Whether white space always begins a new pre-token: byte level with its own pattern, no prefix and no normalizer."""
    parts = json.loads(tokenizer.to_str())
    kind = parts.get("pre_tokenizer") or {}
    return kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space") and not parts.get("normalizer")


def encoded_lengths(tokenizer, texts: list[str], group_bytes: int) -> np.ndarray:
    """Token counts of short texts, encoded in groups of about ``group_bytes`` of UTF-8."""
    counts = np.empty(len(texts), np.int64)
    ends = np.cumsum([len(t) if t.isascii() else len(t.encode()) for t in texts])
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + group_bytes, side="right")))
        counts[at:to] = [len(code) for code in tokenizer.encode_batch_fast(texts[at:to], add_special_tokens=False)]
        at = to
    return counts


def count_texts(tokenizer, texts: list[str], group_bytes: int = 1 << 17, piece: int = 1 << 15) -> np.ndarray:
    """Token counts of ``texts``, encoded in long parts in groups of about ``group_bytes``."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        found = [x for x in pieces(text, piece) if x]
        parts += found
        owner += [i] * len(found)
    counts = np.zeros(len(texts), np.int64)
    if parts:
        np.add.at(counts, owner, encoded_lengths(tokenizer, parts, group_bytes))
    return counts


def count_words(tokenizer, array, known: dict[bytes, int], group_bytes: int = 1 << 17) -> np.ndarray:
    """The same for an array of texts and a tokenizer that is ``by_words``: each different piece of
    white space and what follows it is encoded once, and those in ``known`` not at all."""
    offsets, data = text_buffers(array)
    counts = np.zeros(len(offsets) - 1, np.int64)
    if not len(data):
        return counts
    wide = np.flatnonzero(_WIDE[(data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]])
    odd = np.zeros(len(counts), bool)
    odd[np.searchsorted(offsets, wide, side="right") - 1] = True
    space = (data == 32) | ((data >= 9) & (data <= 13))
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    bounds = np.append(starts, len(data)).astype(np.int64)
    every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    plain = ~odd[owner]
    if odd.any():
        every, owner = every.filter(pa.array(plain)), owner[plain]
    coded = every.dictionary_encode()
    words = coded.dictionary.to_pylist()
    lengths = np.array([known.get(w, -1) for w in words], np.int64)
    new = np.flatnonzero(lengths < 0)
    if len(new):
        lengths[new] = encoded_lengths(tokenizer, [words[i].decode() for i in new.tolist()], group_bytes)
        room = max(0, REMEMBERED - len(known))
        known.update((words[i], n) for i, n in zip(new[:room].tolist(), lengths[new[:room]].tolist()) if len(words[i]) <= REMEMBERED_BYTES)
    if len(owner):
        counts += np.bincount(owner, weights=lengths[coded.indices.to_numpy(zero_copy_only=False)], minlength=len(counts)).astype(np.int64)
    if odd.any():
        at = np.flatnonzero(odd)
        counts[at] = count_texts(tokenizer, array.take(pa.array(at)).to_pylist(), group_bytes)
    return counts


def token_counts(docs: DataFrame, tokenizer_path: str, *, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit.

    ``tokenizer_path`` is a ``tokenizers`` definition; it is read on the driver and sent whole (a few MB, whatever the data).  Null
    and empty texts count 0; a null key stays null; repeated rows are counted each; an empty
    table gives no rows; other columns are ignored.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    words, sent = by_words(_loaded(definition)), docs.sparkSession.sparkContext.broadcast(definition)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for part in text_parts(batches, "t", 4 << 20):
            tokenizer = _loaded(sent.value)
            if words:
                counts = count_words(tokenizer, part.column("t"), _COUNTS.setdefault(hash(sent.value), {}))
            else:
                counts = count_texts(tokenizer, part.column("t").fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("k"), pa.array(byte_lengths(part.column("t")), pa.int64()), pa.array(counts), pa.array(counts > limit)],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.selectExpr(f"`{key}` AS k", f"`{text}` AS t").mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
