import gzip
import hashlib
import io
import struct
import zipfile

import pytest

from corpusmill.llm import token_counts, warc

from .common import docs, sample


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], "page_id long, url string, html string, k int, d string")


def test_round_trip(spark):
    big = "p" * 1200
    rows = [(1, "http://a/", big), (5, "http://b/ c\n", big), (3, None, big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (None, "u", big), (7, "u", "é" * 300_000), (-8, "u", "neg")]
    got = {r["page_id"]: r for r in warc.read_packages(warc.write_packages(pages(spark, rows), package_bytes=4000)).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        raw, r = (html or "").encode(), got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        kind = "revisit" if i in (1, 3) else "response"
        assert (r["record_type"], r["refers_to"]) == (kind, 5 if kind == "revisit" else None)
        assert r["payload"] == (raw if kind == "response" else None)
    assert warc.read_packages(warc.write_packages(pages(spark, []))).count() == 0


def test_zip64_and_comments():
    data = warc.build_package([(warc.warc_record(9, "u", b"hello", None, False, "2020-01-01T00:00:00Z"), {"url": "u", "time": "2020"})])
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None
    end = data.rfind(warc.END)
    count, size, at = struct.unpack("<HII", data[end + 10 : end + 20])
    record = struct.pack("<4sQHHIIQQQQ", warc.END64, 44, 45, 45, 0, 0, count, count, size, at)
    locator = struct.pack("<4sIQI", warc.LOCATOR, 0, end, 1)
    last = struct.pack("<4sHHHHIIH", warc.END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 7) + b"PK\5\6abc"
    for package in (data, data[:end] + record + locator + last):
        (headers, block), = warc.read_package(io.BytesIO(package))
        assert warc.page_of(headers["warc-record-id"]) == 9 and block.endswith(b"hello")


def test_broken_packages():
    with pytest.raises(ValueError):
        warc.zip_members(io.BytesIO(b"no zip"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", gzip.compress(b"x" * 1000))
    with pytest.raises(ValueError):
        list(warc.read_package(io.BytesIO(out.getvalue())))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    from corpusmill.llm.queries import tokenizer_path

    return Tokenizer.from_file(tokenizer_path())


def test_counts_equal_the_library(spark, tokenizer):
    long = "It's 12 o'clock,  see <|endoftext|> there.\n\n\tÉté 中文 " * 9000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "abc"), (4, "a" * 100_000), (5, " " * 5000)]
    from corpusmill.llm.queries import tokenizer_path

    got = token_counts.token_counts(docs(spark, rows), tokenizer_path()).collect()
    want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t in rows]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=str) == sorted(want, key=str)
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    some = sample(spark).select("doc_id", "text").collect()
    by = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(sample(spark), tokenizer_path()).collect()}
    assert by == {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in some}
    assert token_counts.token_counts(docs(spark, []), tokenizer_path()).count() == 0


def test_any_cut_adds_up(tokenizer):
    text = "Some words, 3.5 apples and it's fine. " * 50 + "nocuts" * 50
    for size in (1, 7, 100):
        assert "".join(token_counts.pieces(text, size)) == text
        assert token_counts.count_texts(tokenizer, [text], 50, size)[0] == len(tokenizer.encode(text))


def test_pieces_equal_the_library(tokenizer):
    import random

    import numpy as np
    import pyarrow as pa

    r = random.Random(5)
    signs = ["a", "b", " ", "  ", "\n", "\t", "\r\n", " ", "　", " ", "\x85", "\x1c", "'s", "'", "don't", "1", "½", "中文", "。", "，", ".", "<|endoftext|>", "é", "́", "🎉", "_", "​", "\x00", "ОК"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(3000)] + [None, "", "中文，" * 5000]
    known = {}
    want = [len(e) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for part in (slice(0, 1500), slice(1500, None)):
        got = token_counts.count_words(tokenizer, pa.array(texts[part], pa.string()), known, 500)
        assert got.tolist() == want[part]
    assert known and token_counts.by_words(tokenizer)
    assert np.array_equal(token_counts.count_texts(tokenizer, [t or "" for t in texts], 300, 3), want)
    assert len(list(token_counts.pieces("中文，" * 5000, 100))) > 100


def test_other_tokenizers_count_whole_texts(spark):
    from tokenizers import Tokenizer

    from corpusmill.llm.queries import tokenizer_path

    path = tokenizer_path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    rows = [(r["doc_id"], r["text"]) for r in sample(spark).select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(sample(spark), path).collect()}
    assert not token_counts.by_words(other) and got == {i: len(other.encode(t, add_special_tokens=False)) for i, t in rows}


def test_neighbouring_ranges_are_read_together():
    places = [(0, 10), (10, 5), (15, 5), (5000, 10), (20_000, 1), (20_000, 1)]
    got = list(warc.joined(places, read=100, gap=10))
    assert [(at, n) for at, n, _ in got] == [(0, 20), (5000, 10), (20_000, 1)] and [p for *_, inside in got for p in inside] == sorted(set(places))
    assert [(at, n) for at, n, _ in warc.joined([(0, 60), (60, 60)], read=100)] == [(0, 60), (60, 60)]


def test_foreign_records():
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:x>\r\n"
    headers, block = warc.parse_record(head + b"\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n")
    assert warc._row(headers, block) == (None, None, 4, hashlib.sha1(b"body").hexdigest(), "response", None, b"body")
    headers, block = warc.parse_record(head + b"WARC-Payload-Digest: md5:abc\r\nContent-Length: 2\r\n\r\nab\r\n\r\n")
    assert block == b"ab" and warc._row(headers, block)[2] == 0
    headers, block = warc.parse_record(head + b"WARC-Payload-Digest: sha1:" + hashlib.sha1(b"no").hexdigest().encode() + b"\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n")
    with pytest.raises(ValueError, match="urn:uuid:x"):
        warc._row(headers, block)
    with pytest.raises(ValueError):
        warc.parse_record(head + b"Content-Length: 9\r\n\r\nab")
    assert warc._row({"warc-type": "warcinfo"}, b"") is None
