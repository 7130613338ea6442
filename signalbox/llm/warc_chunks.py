"""WARC archives through a chunked record table.

Writing cuts every payload into chunks of at most ``chunk_bytes`` bytes, one
row per (record, chunk number). Each row becomes one archive record: the first
chunk a ``response``, later ones ``continuation`` records (the format's own
segmentation: WARC-Segment-Number, WARC-Segment-Origin-ID and, on the last,
WARC-Segment-Total-Length). A record ends in CRLF CRLF, so the archives are
plain text-sink files whose line separator is those four bytes.

Reading streams the lines of an archive through a small state machine that
holds one chunk at most. It returns the chunk table: record id, chunk number
and the payload's running byte count and SHA-1 after that chunk. The digest is
carried from chunk to chunk and compared with the declared one at the end, so
no task ever allocates a whole oversized record.

Payloads that equal an earlier one are ``revisit`` records without payload.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbox.llm.common import fresh_path, utf8

CHUNK_BYTES = 1 << 20
RECORD_DATE = "1970-01-01T00:00:00Z"
EOL = "\r\n"
# RFC 4648 base32 alphabet and the digits of conv(..., 32): fixed values.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four groups of ten hex digits (40 bits), eight letters each."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*groups), DIGITS32, BASE32)


def with_record_types(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least ``min_revisit_bytes`` bytes the row(s) with
    the smallest page_id are responses, the others revisit them. Null html is
    an empty payload. A null page_id is larger than any other; repeated rows
    of the smallest page_id are all responses. Only (page_id, digest) pairs
    are aggregated, with a map-side step, so one payload held by a third of
    all pages is no hot group.
    """
    payload = utf8("html")
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )
    first = keyed.groupBy(F.col("payload_digest").alias("first_digest")).agg(
        F.min("page_id").alias("first_id")
    )
    revisit = (F.col("payload_bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return keyed.join(first, F.col("payload_digest") == F.col("first_digest")).select(
        *keyed.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def record_chunks(typed: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table to write: typed rows with chunk_no (from 0), n_chunks and chunk."""
    stored = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    n = F.greatest(F.lit(1), F.ceil(stored / F.lit(chunk_bytes))).cast("int")
    return (
        typed.withColumn("n_chunks", n)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
        .withColumn(
            "chunk",
            F.when(
                F.col("record_type") == "response",
                F.col("payload").substr(F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)),
            ).otherwise(F.lit(b"")),
        )
        .drop("payload")
    )


def _record_text(date: str) -> Column:
    """One archive record without its closing CRLF CRLF."""

    def urn(ident: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(ident.cast("string"), F.lit("null")), F.lit(">"))

    first, last = F.col("chunk_no") == 0, F.col("chunk_no") == F.col("n_chunks") - 1
    segmented = F.col("n_chunks") > 1
    http = F.when(
        first,
        F.concat(
            F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
            F.col("payload_bytes").cast("string"),
            F.lit(EOL + EOL),
        ),
    ).otherwise(F.lit(""))
    url = F.regexp_replace(F.col("url"), "[\\x00-\\x20\\x7F]", "%20")
    optional = [
        F.when(first & F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), url, F.lit(EOL))),
        F.when(first, F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit(EOL))),
        F.when(
            first & (F.col("record_type") == "revisit"),
            F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")), F.lit(EOL)),
        ),
        F.when(segmented, F.concat(F.lit("WARC-Segment-Number: "), (F.col("chunk_no") + 1).cast("string"), F.lit(EOL))),
        F.when(~first, F.concat(F.lit("WARC-Segment-Origin-ID: "), urn(F.col("page_id")), F.lit(EOL))),
        F.when(
            segmented & last,
            F.concat(F.lit("WARC-Segment-Total-Length: "), F.col("payload_bytes").cast("string"), F.lit(EOL)),
        ),
    ]
    ident = F.when(first, urn(F.col("page_id"))).otherwise(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
                 F.lit("#"), F.col("chunk_no").cast("string"), F.lit(">"))
    )
    return F.concat(
        F.lit(f"WARC/1.1{EOL}WARC-Type: "),
        F.when(first, F.col("record_type")).otherwise(F.lit("continuation")),
        F.lit(f"{EOL}WARC-Date: {date}{EOL}WARC-Record-ID: "),
        ident,
        F.lit(EOL),
        *[F.coalesce(x, F.lit("")) for x in optional],
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}Content-Length: "),
        (F.length(http) + F.length("chunk")).cast("string"),
        F.lit(EOL + EOL),
        http,
        F.col("chunk").cast("string"),
    )


def write_archives(
    pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, date: str = RECORD_DATE,
    min_revisit_bytes: int = 0,
) -> None:
    """Write one record per page to gzip archives below ``path``."""
    chunks = record_chunks(with_record_types(pages, min_revisit_bytes), chunk_bytes)
    chunks.select(_record_text(date).alias("value")).write.option("lineSep", EOL * 2).option(
        "compression", "gzip"
    ).text(path)


CHUNK_SCHEMA = (
    "record_id string, page_id long, record_type string, url string, refers_to long, chunk_no int, "
    "chunk binary, running_bytes long, running_digest string, last boolean, payload_bytes long, "
    "payload_digest string, digest_ok boolean"
)


class _ArchiveReader:
    """Turns the byte stream of an archive, fed line by line, into chunk rows."""

    def __init__(self, with_chunks: bool, chunk_bytes: int):
        self.with_chunks, self.chunk_bytes = with_chunks, chunk_bytes
        self.head: dict[str, str] | None = None  # of the record being read
        self.http: list[bytes] | None = None  # lines of the HTTP header being read
        self.left = 0  # bytes of the block still to come
        self.tail = 0  # bytes of the closing CRLF CRLF still to come
        self.buffer = bytearray()  # at most one chunk
        self.record: dict | None = None  # the payload that its segments add to

    def feed(self, line: bytes) -> Iterator[tuple]:
        """``line`` ends in a newline; yields finished chunks."""
        while line:
            if self.left:
                part, line = line[: self.left], line[self.left :]
                self.left -= len(part)
                yield from self._block(part)
                if not self.left:
                    yield from self._block_end()
            elif self.tail:
                n = min(self.tail, len(line))
                if line[:n].strip(b"\r\n"):
                    raise ValueError("archive record is not closed by CRLF CRLF")
                self.tail, line = self.tail - n, line[n:]
            elif self.head is None:
                if line.strip() and not line.startswith(b"WARC/1."):
                    raise ValueError(f"no archive record at {line[:40]!r}")
                self.head, line = ({} if line.strip() else None), b""
            elif line in (b"\r\n", b"\n"):
                line = b""
                yield from self._block_start()
            else:
                name, _, value = line.decode("utf-8", "replace").partition(":")
                self.head[name.strip().lower()] = value.strip()
                line = b""

    def _block_start(self) -> Iterator[tuple]:
        head = self.head
        self.left = int(head["content-length"])
        if head["warc-type"] == "continuation":
            if self.record is None or head["warc-segment-origin-id"] != self.record["id"]:
                raise ValueError("a continuation does not follow its first segment")
            self.http = None
        else:
            self.record = {
                "id": head["warc-record-id"], "type": head["warc-type"], "url": head.get("warc-target-uri"),
                "refers": head.get("warc-refers-to"), "sha1": hashlib.sha1(), "bytes": 0, "no": 0,
                "digest": head.get("warc-payload-digest", "").removeprefix("sha1:"), "declared": None,
            }
            self.http = []
        self.segmented = "warc-segment-number" in head
        self.final = not self.segmented or "warc-segment-total-length" in head
        if not self.left:
            yield from self._block_end()

    def _block(self, part: bytes) -> Iterator[tuple]:
        if self.http is not None:
            self.http.append(part)
            if part in (b"\r\n", b"\n"):
                for line in self.http:
                    name, _, value = line.partition(b":")
                    if name.strip().lower() == b"content-length":
                        self.record["declared"] = int(value)
                self.http = None
            return
        while part:
            room = self.chunk_bytes - len(self.buffer)
            self.buffer += part[:room]
            part = part[room:]
            if len(self.buffer) == self.chunk_bytes and (part or self.left):
                yield self._chunk(False)

    def _block_end(self) -> Iterator[tuple]:
        if self.final or self.buffer:
            yield self._chunk(self.final)
        self.head, self.tail = None, 4

    def _chunk(self, last: bool) -> tuple:
        r, data = self.record, bytes(self.buffer)
        self.buffer.clear()
        r["sha1"].update(data)
        r["bytes"] += len(data)
        running = base64.b32encode(r["sha1"].digest()).decode()
        revisit = r["type"] == "revisit"
        ident = lambda urn: None if urn is None or urn == "<urn:page:null>" else int(urn[10:-1])
        row = (
            r["id"], ident(r["id"]), r["type"], r["url"], ident(r["refers"]), r["no"],
            data if self.with_chunks else None, r["bytes"], running, last,
            r["declared"] if last else None, r["digest"] if last else None,
            None if revisit or not last else (running == r["digest"] and r["bytes"] == r["declared"]),
        )
        r["no"] += 1
        return row


def read_chunks(
    spark: SparkSession, path: str, with_chunks: bool = True, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The chunk table of the archives below ``path`` (see ``CHUNK_SCHEMA``).

    ``with_chunks=False`` leaves the bytes out and keeps counts and digests.
    Archives are gzip files, so one task reads a file from start to end.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(CHUNK_SCHEMA))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rows, size = _ArchiveReader(with_chunks, chunk_bytes), [], 0
        for batch in batches:
            for value in batch.column(0):
                for row in reader.feed(value.as_py() + b"\n"):
                    rows.append(row)
                    size += len(row[6] or b"") + 256
                    if size > 4 << 20:
                        yield _batch(rows, schema)
                        rows, size = [], 0
        if reader.head is not None or reader.left:
            raise ValueError("archive ends inside a record")
        if rows:
            yield _batch(rows, schema)

    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary"))
    return lines.mapInArrow(parse, CHUNK_SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def archive_digests(spark: SparkSession, pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` as archives, read them back, one row per record.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to,
    digest_ok (the digest carried over the chunks equals the declared one;
    null for revisits), n_chunks. An empty table gives no rows.
    """
    path = fresh_path(spark, "warc")
    write_archives(pages, path, chunk_bytes)
    return (
        read_chunks(spark, path, with_chunks=False, chunk_bytes=chunk_bytes)
        .filter("last")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok",
                (F.col("chunk_no") + 1).alias("n_chunks"))
    )
