"""WARC archives: records with revisits, a normaliser for monolithic gzip files, and reading by a sidecar index."""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import as_bytes, new_folder, table, written
from llm.files import create, reading
from llm.registry import query

CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "file string, records bigint, bytes bigint"
NORMAL = "file string, index string, records bigint, bytes bigint, error string"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


# --- records -------------------------------------------------------------------------------------------


def record(page_id, url, payload: bytes | None, n_bytes: int, digest: str, refers_to, date: str) -> bytes:
    """One WARC 1.1 record. A revisit has no payload of its own; its length stands in a header."""
    body = payload if refers_to is None else b""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        *([] if url is None else [("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~"))]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(n_bytes)),
        *([] if refers_to is None else [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(body))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; ``head`` ends before the empty line."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing -------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: html is null where an equal payload of at least ``min_bytes`` bytes has a
    smaller page_id, which refers_to names.

    Only ids and digests of payloads meet per digest (combined before the shuffle); the payloads move once, by
    page_id, so that a payload shared by a third of the pages is dealt evenly.
    """
    payload = F.coalesce("html", F.lit(""))
    seen = pages.select(
        "page_id", F.sha2(payload, 256).alias("_sum"), F.octet_length(payload).alias("_bytes")
    ).filter((F.col("_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    firsts = seen.groupBy("_sum").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n")).filter("_n > 1")
    revisits = (
        seen.join(firsts, "_sum").filter("page_id <> refers_to").groupBy("page_id", "_sum").agg(F.min("refers_to").alias("refers_to"))
    )
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("_sum", F.sha2("html", 256))
    return own.join(revisits, ["page_id", "_sum"], "left").select("page_id", "url", "html", "refers_to")


def write_monolithic(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 1
) -> DataFrame:
    """Writes every page as a record; each task makes one .warc.gz that is a single gzip stream. Returns the files.

    A record streams through the compressor, so a task holds one batch of pages. Null page_ids are written without
    an id, are never revisits and never referred to; of repeated rows with one page_id and payload, all are alike.
    Null html is an empty payload. Extra columns are not written.
    """

    def write(rows):
        deflate, stream, held, n, size = None, None, None, 0, 0
        try:
            for batch in rows:
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if deflate is None:
                        held = create(folder, ".warc.gz")
                        name, stream = held.__enter__()
                        deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
                    payload = as_bytes(html)
                    data = record(page_id, url, payload, len(payload), digest_of(payload), refers_to, date)
                    size += stream.write(deflate.compress(data)) or 0
                    n += 1
            if deflate is not None:
                stream.write(deflate.flush())
                size = stream.tell()
        finally:
            if held is not None:
                held.__exit__(None, None, None)
        if deflate is not None:
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "records": [n], "bytes": [size]},
                pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )

    return written(with_revisits(pages, min_bytes).mapInArrow(write, FILES), "warc-files")


# --- the normaliser ------------------------------------------------------------------------------------


class Inflated:
    """The inflated content of a gzip stream, one member or many, read in order and in bounded pieces."""

    def __init__(self, stream):
        self.stream, self.inflate, self.rest, self.held = stream, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Adds up to CHUNK bytes to ``held``; False at the end."""
        while True:
            if self.inflate.eof:
                self.rest = self.inflate.unused_data or self.stream.read(CHUNK)
                if not self.rest:
                    return False
                self.inflate = zlib.decompressobj(31)
            elif not self.rest:
                self.rest = self.stream.read(CHUNK)
                if not self.rest:
                    raise EOFError("the gzip stream ends within a member")
            data = self.inflate.decompress(self.rest, CHUNK)
            self.rest = self.inflate.unconsumed_tail
            if data:
                self.held += data
                return True

    def head(self) -> bytes | None:
        """Up to the next empty line, without it, at any length; None at the end. What begins unlike a record is not
        searched further than CHUNK."""
        seen = 0
        while (at := self.held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.held)
            if seen > CHUNK and not self.held[:CHUNK].lstrip(b"\r\n").startswith(b"WARC/"):
                raise ValueError("no end of the record's header")
            if not self.more():
                if self.held.strip():
                    raise EOFError("the file ends within a header")
                return None
        out, self.held = self.held[:at], self.held[at + 4 :]
        return out

    def body(self, n: int):
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.held and not self.more():
                raise EOFError("the file ends within a record")
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            yield piece


def normalise(files: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites each file (column ``file``) so that every record is a gzip member of its own, with a sidecar index.

    A file is inflated once, as a stream. The index has a line for each record: offset, length and record id.
    Returns file, index, records, bytes and error: a damaged file keeps the records before the damage and names it.
    An empty file gives an empty archive. Columns of ``files`` besides ``file`` are ignored.
    """

    def rewrite(rows):
        for batch in rows:
            for source in batch.column(0).to_pylist():
                n, error, index = 0, None, []
                with create(folder, ".warc.gz") as (name, out):
                    with reading(source) as stream:
                        content = Inflated(stream)
                        try:
                            while (head := content.head()) is not None:
                                head = head.lstrip(b"\r\n")
                                fields = fields_of(head)
                                member, start = zlib.compressobj(level, zlib.DEFLATED, 31), out.tell()
                                pieces = [member.compress(head + b"\r\n\r\n")]
                                for piece in content.body(int(fields["content-length"])):
                                    pieces.append(member.compress(piece))
                                for piece in content.body(4):
                                    pieces.append(member.compress(piece))
                                out.write(b"".join(pieces) + member.flush())
                                index.append((start, out.tell() - start, fields.get("warc-record-id", "")))
                                n += 1
                        except (EOFError, ValueError, KeyError, zlib.error) as problem:
                            error = f"{type(problem).__name__}: {problem}"
                    size = out.tell()
                with create(folder, ".idx") as (sidecar, out):
                    out.write("".join(json.dumps(x) + "\n" for x in index).encode())
                yield pa.RecordBatch.from_pydict(
                    {"file": [name], "index": [sidecar], "records": [n], "bytes": [size], "error": [error]},
                    pa.schema([("file", pa.string()), ("index", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("error", pa.string())]),
                )

    return written(_dealt(files.select("file")).mapInArrow(rewrite, NORMAL), "warc-normal")


def _dealt(files: DataFrame) -> DataFrame:
    """A task for each file or few, whatever the number of part files the names came in."""
    return files.repartition(max(1, files.count()))


# --- reading -------------------------------------------------------------------------------------------


def read_records(files: DataFrame) -> DataFrame:
    """Every record of normalised archives, found through the index and inflated alone. An index with more or fewer
    records than its file's ``records`` fails the job."""

    def page(value: str | None):
        text = (value or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def read(rows):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in rows:
            for name, sidecar, records in zip(*(c.to_pylist() for c in batch.columns)):
                with reading(sidecar) as stream:
                    index = [json.loads(line) for line in stream.read().splitlines()]
                if len(index) != records:
                    raise ValueError(f"{name}: {len(index)} records in the index, {records} written")
                with reading(name) as stream:
                    for at in range(0, len(index), 4096):
                        out = []
                        for start, length, _ in index[at : at + 4096]:
                            stream.seek(start)
                            head, _, body = zlib.decompress(stream.read(length), 31).partition(b"\r\n\r\n")
                            f = fields_of(head)
                            body = body[: int(f["content-length"])]
                            digest = f["warc-payload-digest"].removeprefix("sha1:")
                            if f["warc-type"] == "response" and digest_of(body) != digest:
                                raise ValueError(f"{name}: payload of {f['warc-record-id']} does not match its digest")
                            out.append(
                                (page(f["warc-record-id"]), f.get("warc-target-uri"), int(f["x-payload-length"]), digest, f["warc-type"], page(f.get("warc-refers-to")))
                            )
                        if out:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)

    return _dealt(files.select("file", "index", "records")).mapInArrow(read, RECORDS)


def whole(files: DataFrame, records: int) -> DataFrame:
    """``files`` of the normaliser; raises if one has an error or they have other than so many records together."""
    damaged = files.filter("error IS NOT NULL").select("file", "error").first()
    if damaged:
        raise ValueError(f"{damaged['file']}: {damaged['error']}")
    found = files.agg(F.sum("records")).first()[0] or 0
    if found != records:
        raise ValueError(f"{found} of {records} records normalised")
    return files


def archive(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages to monolithic archives to normalised ones in the shared folder. Returns the normalised files, or raises if
    one is damaged or the records are not as many as were written."""
    folder = new_folder(spark, "warc")
    files = write_monolithic(pages, f"{folder}/monolithic", min_bytes)
    return whole(normalise(files, f"{folder}/normal"), files.agg(F.sum("records")).first()[0] or 0)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h,
    min(page_id) OVER (PARTITION BY html) AS first
  FROM p
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 10 * (i // 8) AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS INTEGER), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""


@query("op8_warc_normaliser", SQL)
def op8_warc_normaliser(spark, sf_dir):
    files = archive(spark, table(spark, sf_dir, "pages"))
    return read_records(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
