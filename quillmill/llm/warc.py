"""Web archives: pages as WARC records, and a normaliser for archives of one gzip stream.

An archive that was compressed as a whole can only be read from its start. The
normaliser inflates such a file once as a stream, writes every record as a gzip member of
its own, and beside it an index of the members' offsets, so that each record can be read
by itself. Records of any length pass through in small parts.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from quillmill.durable import durable

SMALLEST_SHARED = 100
PART = 1 << 20
END = b"\r\n\r\n"
# fixed values of the format
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
FILES = "path string, index_path string, records bigint"


def record_types(pages: DataFrame, id: str = "page_id", html: str = "html", smallest: int = SMALLEST_SHARED) -> DataFrame:
    """``id, digest, refers_to`` of the rows that repeat the payload of a smaller id.

    Null pages are empty payloads. Payloads under ``smallest`` bytes are never repeats.
    Rows that repeat the smallest id itself are no repeats; null ids come after all
    others. Only digests and ids are shuffled, combined by task before.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(id).alias("id"), F.unhex(F.sha2(payload, 256)).alias("digest"), F.octet_length(payload).alias("bytes")).where(F.col("bytes") >= smallest)
    first = rows.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to"))).groupBy("id", "digest").agg(F.min("refers_to").alias("refers_to"))


def record_id(id) -> str:
    return f"<urn:x-page:{'null' if id is None else id}>"


def page_of(uri: str) -> int | None:
    value = uri.rsplit(":", 1)[1].rstrip(">")
    return None if value == "null" else int(value)


def page_record(id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """A response, or a revisit that keeps the HTTP header but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(id), "WARC-Date": DATE}
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if revisit:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to)}
    fields |= {"WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(), "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + END


def write_archives(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One record per row, in one gzip stream per task, under the shared URI ``path``.

    Returns the file list. Rows without a url have no target; repeated rows are all
    written; an empty table gives no files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(path)
        name, out, records = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0
        for row in (row for batch in batches for at in range(0, batch.num_rows, 256) for row in batch.slice(at, 256).to_pylist()):
            if out is None:
                files.create_dir(root)
                out, stream = files.open_output_stream(name, compression=None), zlib.compressobj(1, wbits=31)
            out.write(stream.compress(page_record(row["id"], row["url"], (row["html"] or "").encode(), row["refers_to"], row["revisit"])))
            records += 1
        if out is not None:
            out.write(stream.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([None], pa.string()), pa.array([records], pa.int64())], ["path", "index_path", "records"])

    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(id).cast("bigint").alias("id"), F.col(url).alias("url"), body.alias("html"), F.unhex(F.sha2(body, 256)).alias("digest"))
    repeats = record_types(pages, id, html).select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "refers_to", F.lit(True).alias("revisit"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    typed = rows.join(repeats, same, "left").select("id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))
    return durable(typed.mapInArrow(write, FILES), "archives")


def read_header(stream) -> tuple[bytes, dict[str, str]] | None:
    """Raw header and its fields at the start of a record; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record starts with {line[:40]!r}")
    raw, fields = [line], {}
    while (line := stream.readline()).strip():
        raw.append(line)
        if line[:1] in b" \t" and fields:  # a continued field
            fields[name] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, _, value = line.decode("utf-8", "replace").partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()
    if not line:
        raise EOFError("the archive ends inside a record's header")
    return b"".join(raw) + b"\r\n", fields


def normalise_stream(source, target, level: int = 6) -> Iterator[dict]:
    """Rewrite the records of a compressed stream as members; yields their index rows.

    The stream may itself consist of several members. A cut-off stream is an error.
    """
    stream, offset = io.BufferedReader(gzip.GzipFile(fileobj=source), PART), 0
    while (found := read_header(stream)) is not None:
        header, fields = found
        member = zlib.compressobj(level, wbits=31)
        start, left = offset, int(fields["content-length"])
        parts = [member.compress(header)]
        while left:
            part = stream.read(min(left, PART))
            if not part:
                raise EOFError("the archive ends inside a record")
            left -= len(part)
            parts.append(member.compress(part))
            if sum(map(len, parts)) > PART:
                offset += target.write(b"".join(parts))
                parts = []
        offset += target.write(b"".join([*parts, member.compress(END), member.flush()]))
        yield {"offset": start, "length": offset - start, "id": fields["warc-record-id"], "type": fields["warc-type"], "uri": fields.get("warc-target-uri")}


def normalise_archives(archives: DataFrame, path: str) -> DataFrame:
    """Normalise each file of a list, one per task, into ``path``; returns the new list.

    The index beside a file has one JSON object per line and record.
    """

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(path)
        files.create_dir(root)
        for row in (row for batch in batches for row in batch.to_pylist()):
            name, records = f"{root}/{uuid.uuid4().hex}", 0
            with (
                files.open_input_stream(row["path"], compression=None, buffer_size=PART) as source,
                files.open_output_stream(f"{name}.warc.gz", compression=None, buffer_size=PART) as target,
                files.open_output_stream(f"{name}.index", compression=None, buffer_size=PART) as index,
            ):
                for entry in normalise_stream(source, target):
                    index.write(json.dumps(entry).encode() + b"\n")
                    records += 1
            yield pa.RecordBatch.from_arrays([pa.array([f"{name}.warc.gz"]), pa.array([f"{name}.index"]), pa.array([records], pa.int64())], ["path", "index_path", "records"])

    spread = archives.repartition(max(1, archives.count()), "path")
    return durable(spread.mapInArrow(normalise, FILES), "normalised")


def read_record(file, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of the record at an offset, fields of its HTTP header, and its payload."""
    file.seek(offset)
    stream = io.BytesIO(zlib.decompress(file.read(length), wbits=31))
    _, fields = read_header(stream)
    head, _, payload = stream.read(int(fields["content-length"])).partition(END)
    http = dict(line.lower().split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return fields, http, payload


def read_archives(archives: DataFrame, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record.

    Each record is looked up by its offset. The payload of a response must have the
    digest and length that its header states; a revisit states those of the full payload.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(path)
        for row in (row for batch in batches for row in batch.to_pylist()):
            with files.open_input_stream(row["index_path"], compression=None) as index:
                entries = [json.loads(line) for line in index.read().splitlines()]
            found = []
            with files.open_input_file(row["path"]) as archive:
                for entry in entries:
                    fields, http, payload = read_record(archive, entry["offset"], entry["length"])
                    digest, size = fields["warc-payload-digest"].removeprefix("sha256:"), int(http["content-length"])
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError(f"{entry['id']}: the payload is not what its header states")
                    refers = page_of(fields["warc-refers-to"]) if revisit else None
                    found.append((page_of(fields["warc-record-id"]), size, digest, fields["warc-type"], refers))
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 5, types)], NAMES)

    NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    spread = archives.repartition(max(1, archives.count()), "path")
    return spread.mapInArrow(read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
