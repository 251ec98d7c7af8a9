"""WARC in ZIP packages: a writer, and a reader that range-reads records without extraction.

A package holds a stored member ``archive/data.warc.gz`` (one gzip member for each record) and
a stored index with a line for each record: URL key, time, JSON with offset and length.  The
reader parses the end-of-directory records, ZIP64 ones included, and the central directory,
finds the data of stored members from their local headers, and reads each record by its range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, materialize, shared_path, text_parts

#: Fixed values of the ZIP format: signatures.
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: The upper halves of record ids; the lower half is the page's id.
PAGE, NO_PAGE = 0x7A1B6C3D5E4F4A90, 0x7A1B6C3D5E4F4A91


# ---------------------------------------------------------------- ZIP


def open_uri(uri: str):
    """A random-access file of any store that Arrow reads."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def read_at(f, offset: int, length: int) -> bytes:
    f.seek(offset)
    data = f.read(length)
    if len(data) != length:
        raise ValueError(f"the package ends inside a record at {offset}")
    return data


def zip_members(f) -> dict[str, tuple[int, int, int, int]]:
    """{name: (method, local header's offset, packed size, size)} from the central directory."""
    f.seek(0, 2)
    total = f.tell()
    tail_at = max(0, total - 65557)
    tail = read_at(f, tail_at, total - tail_at)
    end = tail.rfind(END)
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(END, 0, end)
    if end < 0:
        raise ValueError("not a ZIP package: it has no end of central directory")
    count, size, at = struct.unpack("<HII", tail[end + 10 : end + 20])
    if count == 0xFFFF or 0xFFFFFFFF in (size, at):
        where = tail_at + end - 20
        locator = read_at(f, where, 20) if where >= 0 else b""
        if locator[:4] != LOCATOR:
            raise ValueError("the ZIP64 locator is missing")
        record = read_at(f, struct.unpack("<Q", locator[8:16])[0], 56)
        if record[:4] != END64:
            raise ValueError("the ZIP64 end of central directory is missing")
        count, size, at = struct.unpack("<QQQ", record[32:56])
    directory, pos, members = read_at(f, at, size), 0, {}
    for _ in range(count):
        if directory[pos : pos + 4] != CENTRAL:
            raise ValueError("the central directory is broken")
        method, packed, plain, n, extra_n, comment_n, offset = struct.unpack("<10xH8xIIHHH8xI", directory[pos : pos + 46])
        name = directory[pos + 46 : pos + 46 + n].decode()
        extra, wide, k = directory[pos + 46 + n : pos + 46 + n + extra_n], b"", 0
        while k + 4 <= len(extra):
            kind, m = struct.unpack("<HH", extra[k : k + 4])
            if kind == 1:
                wide = extra[k + 4 : k + 4 + m]
            k += 4 + m
        values = [plain, packed, offset]
        for i, v in enumerate(values):
            if v == 0xFFFFFFFF:
                values[i], wide = int.from_bytes(wide[:8], "little"), wide[8:]
        members[name] = (method, values[2], values[1], values[0])
        pos += 46 + n + extra_n + comment_n
    return members


def member_range(f, member: tuple[int, int, int, int]) -> tuple[int, int]:
    """(offset, length) of a stored member's bytes in the package."""
    method, at, packed, _ = member
    if method != 0:
        raise ValueError("the member is compressed; only stored ones can be read by range")
    header = read_at(f, at, 30)
    if header[:4] != LOCAL:
        raise ValueError("the local header is missing")
    return at + 30 + sum(struct.unpack("<HH", header[26:30])), packed


# ---------------------------------------------------------------- records


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(NO_PAGE if page is None else PAGE) << 64 | (page or 0) & (1 << 64) - 1)}>"


def page_of(urn: str) -> int | None:
    """The page whose id a record's id holds; null for any other id."""
    try:
        n = uuid.UUID(urn.strip("<>").rpartition(":")[2]).int
    except ValueError:
        return None
    low = n & (1 << 64) - 1
    return (low - (1 << 64) if low >> 63 else low) if n >> 64 == PAGE else None


def warc_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, block) of one WARC record; without a Content-Length the block
    is all that is there but the empty lines at its end."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = headers.get("content-length", "")
    if not length.isdigit():
        return headers, rest[:-4] if rest.endswith(b"\r\n\r\n") else rest
    if int(length) > len(rest):
        raise ValueError(f"{headers.get('warc-record-id', 'a record')}: its block is shorter than its Content-Length")
    return headers, rest[: int(length)]


def build_package(records: list[tuple[bytes, dict]]) -> bytes:
    """A ZIP package of (record, index fields)."""
    body, lines = io.BytesIO(), []
    for record, fields in records:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        fields = {**fields, "offset": str(body.tell()), "length": str(len(packed)), "filename": "data.warc.gz"}
        lines.append(f"{fields.get('url', '-')} {fields.pop('time')} {json.dumps(fields)}\n")
        body.write(packed)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in ((ARCHIVE, body.getvalue()), (INDEX, "".join(lines).encode()), ("datapackage.json", b'{"profile": "data-package", "wacz_version": "1.1.1"}')):
            with z.open(name, "w", force_zip64=True) as member:
                member.write(data)
    return out.getvalue()


#: Bytes that one read takes at most where several records lie side by side, and bytes between them that it may take along.
READ, GAP = 4 << 20, 4096


def joined(places: list[tuple[int, int]], read: int = READ, gap: int = GAP):
    """(offset, length, the places inside) of reads that cover every (offset, length) once, in order."""
    group: list[tuple[int, int]] = []
    end = 0
    for at, n in sorted(set(places)):
        if group and (at > end + gap or at + n - group[0][0] > read):
            yield group[0][0], end - group[0][0], group
            group = []
        end = max(end, at + n) if group else at + n
        group.append((at, n))
    if group:
        yield group[0][0], end - group[0][0], group


def read_package(f):
    """(headers, block) of every record that the package's indexes list, by ranges; neighbours are
    read together, so that a store is asked once for many small records."""
    members = zip_members(f)
    archives = {n.rpartition("/")[2]: member_range(f, m) for n, m in members.items() if n.startswith("archive/")}
    for name, member in members.items():
        if name.startswith("indexes/") and re.search(r"\.cdxj?(\.gz)?$", name):
            text = read_at(f, *member_range(f, member))
            text = gzip.decompress(text) if name.endswith(".gz") else text
            places = []
            for line in text.decode().splitlines():
                if "{" not in line:
                    continue
                fields = json.loads(line[line.index("{") :])
                base, size = archives[fields["filename"].rpartition("/")[2]]
                at, n = int(fields["offset"]), int(fields["length"])
                if at + n > size:
                    raise ValueError("the index points behind its archive")
                places.append((base + at, n))
            for start, length, inside in joined(places):
                data = read_at(f, start, length)
                for at, n in inside:
                    yield parse_record(zlib.decompress(data[at - start : at - start + n], 31))


# ---------------------------------------------------------------- operators


def write_packages(pages: DataFrame, *, key: str = "page_id", url: str = "url", body: str = "html", min_bytes: int = 1000, package_bytes: int = 32 << 20, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record for each row of ``pages`` into packages in the shared folder; returns
    their URIs (path, n_records).

    Of rows with equal payloads of ``min_bytes`` or more, that with the largest key is a
    response and the others revisit it; smaller payloads are responses, null ones are empty.  Rows
    with a null key never stand for others, and are responses; repeated rows with the largest key are
    responses all.  Only files that a finished task has named are read, so lost executors leave
    at most files that nobody names.
    """
    folder = shared_path(pages.sparkSession, "packages")
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u"), F.coalesce(F.col(body).cast("string"), F.lit("")).alias("b"))
    rows = rows.withColumn("d", F.when((F.octet_length("b") >= min_bytes) & F.col("k").isNotNull(), F.sha1(F.col("b").cast("binary"))))
    held = rows.where("d IS NOT NULL").groupBy("d").agg(F.max("k").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("d").alias("e"), "first")
    held = materialize(held, "repeated_payloads")
    # rows that can repeat nothing pass by the join: their nulls would all meet in one task
    alone = rows.where("d IS NULL").select("k", "u", "b", F.lit(None).cast("long").alias("r"))
    rows = rows.where("d IS NOT NULL").join(broadcast_if_small(held), F.col("d") == F.col("e"), "left").select("k", "u", "b", F.when(F.col("first") != F.col("k"), F.col("first")).alias("r"))
    rows = rows.unionAll(alone)

    def write(batches):
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)

        def save(records):
            name = f"{uuid.uuid4().hex}.wacz"
            with system.open_output_stream(f"{base}/{name}") as out:
                out.write(build_package(records))
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [len(records)]})

        held, size = [], 0
        for part in text_parts(batches, "b", package_bytes):
            for k, u, b, r in zip(*(part.column(c).to_pylist() for c in "kubr")):
                payload = b.encode()
                record = warc_record(k, u, payload, r, r is not None, date)
                held.append((record, {"url": u or "-", "time": re.sub(r"\D", "", date), "mime": "text/html", "status": "200"}))
                size += len(record)
                if size >= package_bytes:
                    yield save(held)
                    held, size = [], 0
        if held:
            yield save(held)

    return materialize(rows.mapInArrow(write, "path string, n_records long"), "written")


def read_packages(packages: DataFrame, *, path: str = "path", key: str = "page_id") -> DataFrame:
    """One row for each record of the packages: key, url, payload_bytes, payload_digest (hex
    SHA-1), record_type, refers_to, payload (null for revisits).

    Records other than responses and revisits are left out, and so is what no index lists; a record that an index
    lists twice comes once.  A record without a page's id has a null key, one without a URL a null
    url; a payload without a digest, or with one that is no SHA-1, gets its own SHA-1 (null for a revisit).
    Payloads of any length are read whole.  Repeated packages give repeated rows, an empty table of packages none; its
    other columns are ignored.  A payload that differs from its digest, a record cut short and a broken package raise
    an error that names the package.
    """

    def read(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, size = [], 0
                try:
                    with open_uri(uri) as f:
                        for headers, block in read_package(f):
                            row = _row(headers, block)
                            if row is None:
                                continue
                            rows.append(row)
                            size += len(row[-1] or b"")
                            if size > 4 << 20:
                                yield _rows(rows, key)
                                rows, size = [], 0
                except (ValueError, KeyError, zlib.error, struct.error) as e:
                    raise ValueError(f"{uri}: {e}") from e
                if rows:
                    yield _rows(rows, key)

    schema = f"`{key}` bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    return packages.select(path).mapInArrow(read, schema)


def _row(headers: dict[str, str], block: bytes) -> tuple | None:
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    name, refers = headers.get("warc-record-id", ""), headers.get("warc-refers-to")
    algorithm, _, value = headers.get("warc-payload-digest", "").partition(":")
    digest = _sha1(value) if algorithm.lower() == "sha1" else None
    if kind == "response":
        own = hashlib.sha1(payload).hexdigest()
        if digest is not None and digest != own:
            raise ValueError(f"{name}: the payload differs from its digest")
        return page_of(name), headers.get("warc-target-uri"), len(payload), own, kind, None, payload
    length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    return page_of(name), headers.get("warc-target-uri"), int(length[1]) if length else None, digest, kind, refers and page_of(refers), None


def _sha1(value: str) -> str | None:
    """The hex form of a SHA-1 in base 32 or hex; null for anything else."""
    try:
        raw = base64.b32decode(value.upper()) if len(value) == 32 else bytes.fromhex(value)
    except ValueError:
        return None
    return raw.hex() if len(raw) == 20 else None


def _rows(rows: list[tuple], key: str) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[key, "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS b, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
 r AS (SELECT *, sha1(b) AS payload_digest, max(page_id) OVER (PARTITION BY b) AS m FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN payload_bytes >= 1000 AND m <> page_id THEN m END AS refers_to FROM r"""
