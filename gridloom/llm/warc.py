"""Zstandard-compressed WARC archives: writer and reader.

An archive holds one dictionary in a leading skippable frame (magic
0x184D2A5D), then one Zstandard frame per record, each compressed with that
dictionary.  ``write_archives`` builds archives of bounded size inside tasks
and returns them as rows (path, content), the shape of Spark's ``binaryFile``
source; ``read_archives`` takes such rows, so it reads archives that this
module wrote and ``*.warc.zst`` files alike.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with
the smallest page id is a ``response``; the others are ``revisit`` records
that name it and carry no payload.  Equality is that of the SHA-256 digests.

The dictionary is trained in the task on the first payloads of its archive
(at most ``DICT_SAMPLES`` of them, ``DICT_BYTES`` long); an archive with too
few samples for training has no dictionary frame, which the format allows.

Edge cases: a null payload is empty; records without an id have the id
``none`` and are read back with a null page id, and never refer to or stand
for another; repeated rows of the page that is the response are responses
too.  A payload of any length is one record, held whole by the task that
writes it; an empty table gives no archives.  Only the three named columns are
read, so others may clash with anything.  A null URL leaves the target header
out; control characters in a URL are percent-encoded.  A frame or record that fails validation is returned
with its ``error`` and null columns, it does not stop the job.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
DICT_SAMPLES = 200
DICT_BYTES = 8 * 1024
SAMPLE_BYTES = 8 * 1024
ARCHIVE_BYTES = 4 * 1024 * 1024
LEVEL = 3
WARC_DATE = "1970-01-01T00:00:00Z"

ARCHIVE_SCHEMA = "path string, content binary"
RECORD_SCHEMA = ("path string, page_id long, record_type string, target_uri string, "
                 "payload_bytes long, payload_digest string, refers_to long, "
                 "payload binary, error string")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html", min_bytes: int = 100) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, digest,
    refers_to.  The smallest id per digest is a partial aggregate over
    (digest, id); only digests that occur twice are joined back."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "digest": F.sha2("payload", 256)})
    firsts = (rows.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
              .groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
              .filter("n > 1").select("digest", "first_id"))
    planned = rows.join(firsts, "digest", "left")
    refers = F.when(F.col("page_id") != F.col("first_id"), F.col("first_id"))
    return planned.select(
        "page_id", "url", "payload_bytes", "digest", refers.alias("refers_to"),
        F.when(refers.isNull(), F.col("payload")).alias("payload"))


# ------------------------------------------------------------------- writer

def _record(page_id, url, payload_bytes, digest, refers_to, payload) -> bytes:
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()
    block = http + (payload if refers_to is None else b"")
    name = "none" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {WARC_DATE}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    samples = [r[:SAMPLE_BYTES] for r in records[:DICT_SAMPLES]]
    if len(samples) < 8 or sum(map(len, samples)) < 4 * DICT_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=200, d=8)
    except zstandard.ZstdError:
        return None


def archive_bytes(records: list[bytes]) -> bytes:
    """One archive: dictionary frame (if one can be trained), then frames."""
    trained = _train(records)
    out = io.BytesIO()
    if trained is not None:
        raw = trained.as_bytes()
        out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    for record in records:
        out.write(packer.compress(record))
    return out.getvalue()


def write_archives(records: DataFrame, archive_size: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows of ``plan_records`` -> archives (path, content).  Each task cuts
    its records into archives of about ``archive_size`` bytes before
    compression, so memory does not grow with the partition."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(held: list[bytes]) -> pa.RecordBatch:
            content = archive_bytes(held)
            name = hashlib.sha256(content).hexdigest()[:24]
            return pa.RecordBatch.from_pydict(
                {"path": pa.array([f"{name}.warc.zst"]), "content": pa.array([content], pa.binary())})

        held: list[bytes] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "payload_bytes", "digest", "refers_to", "payload"))):
                held.append(_record(*row))
                size += len(held[-1])
                if size >= archive_size:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    return records.mapInArrow(write, ARCHIVE_SCHEMA)


# ------------------------------------------------------------------- reader

def frame_end(data: memoryview, at: int) -> int:
    """The end of the Zstandard frame that starts at ``at``, by walking its
    block headers; raises ValueError on a broken or truncated frame."""
    if len(data) < at + 6 or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise ValueError("no Zstandard frame")
    flags = data[at + 4]
    single = flags >> 5 & 1
    content_size = (single, 2, 4, 8)[flags >> 6]
    pos = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + content_size
    last = 0
    while not last:
        if pos + 3 > len(data):
            raise ValueError("truncated frame")
        block = data[pos] | data[pos + 1] << 8 | data[pos + 2] << 16
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        pos += 3 + (1 if kind == 1 else size)
    pos += 4 * (flags >> 2 & 1)
    if pos > len(data):
        raise ValueError("truncated frame")
    return pos


def _parse(record: bytes) -> dict:
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line[:60]!r}")
        fields[key.strip().lower()] = value.strip()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if key not in fields:
            raise ValueError(f"no {key}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("record length differs from Content-Length")
    http, mark, payload = rest[:length].partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no HTTP header")
    size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if size is None:
        raise ValueError("no HTTP Content-Length")
    size = int(size[1])
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload differs from its length or digest")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields:
            raise ValueError("revisit with a payload or without a target record")
    else:
        raise ValueError(f"unknown record type {kind[:40]!r}")
    number = lambda text: int(text[10:-1]) if re.fullmatch(r"<urn:page:-?\d+>", text) else None
    return {"page_id": number(fields["warc-record-id"]), "record_type": kind,
            "target_uri": fields.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest, "refers_to": number(fields.get("warc-refers-to", "")),
            "payload": payload if kind == "response" else None, "error": None}


def read_content(content: bytes) -> Iterator[dict]:
    """The records of one archive, in order."""
    data, pos, unpacker = memoryview(content), 0, zstandard.ZstdDecompressor()
    if len(data) >= 8:
        magic, size = struct.unpack_from("<II", data, 0)
        if magic == DICT_MAGIC:
            raw = bytes(data[8:8 + size])
            if len(raw) >= 4 and struct.unpack_from("<I", raw)[0] == FRAME_MAGIC:
                raw = zstandard.ZstdDecompressor().decompress(raw)  # a packed dictionary
            unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
            pos = 8 + size
    while pos < len(data):
        try:
            end = frame_end(data, pos)
        except ValueError as exc:  # nothing after it can be found
            yield {"error": str(exc)}
            return
        try:
            yield _parse(unpacker.decompressobj().decompress(bytes(data[pos:end])))
        except (ValueError, zstandard.ZstdError) as exc:
            yield {"error": str(exc)}
        pos = end


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """(path, content) rows -> one row per record (``RECORD_SCHEMA``)."""
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RECORD_SCHEMA.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                held, size = [], 0
                for record in read_content(content.as_py() or b""):
                    size += len(record.get("payload") or b"")
                    if not with_payload:
                        record["payload"] = None
                    held.append(record | {"path": path})
                    if size > 4 * ARCHIVE_BYTES:
                        yield _batch(held, names, schema)
                        held, size = [], 0
                if held:
                    yield _batch(held, names, schema)

    return archives.select("path", "content").mapInArrow(read, RECORD_SCHEMA)


def _batch(records: list[dict], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(n) for r in records], schema.field(n).type) for n in names], schema=schema)
