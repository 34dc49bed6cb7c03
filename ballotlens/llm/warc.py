"""WARC archives: written as one gzip stream per file, normalised to one gzip
member per record with a sidecar offset index, and read back.

All files go through Spark's own readers and writers, so any shared file system
will do and a repeated task leaves no half-written archive:

* ``write_monolithic``: the text writer lays the records of a partition into
  one gzip stream (a record's closing CRLF CRLF ends in the line separator).
* ``normalise``: each file is inflated once as a stream; every record becomes a
  gzip member of its own. Members are written by the text writer too, many to a
  line; its line separator is an empty gzip member, so that a file is a plain
  sequence of record members, with an empty end marker after each
  ``CHUNK_BYTES`` and at the end.
* ``index_archives``: one walk over the normalised files gives, for each
  record, archive, offset, length and the main header fields; written beside
  the archives. ``read_records`` fetches payloads by that index.

Of records with equal payloads (SHA-1 and length) of at least
``min_revisit_bytes`` that with the smallest page_id is the response and the
others revisit it.

Defined cases: null html is an empty payload; a null url is left out of the
header, and white space and control characters in a url become %20; repeated
rows of the smallest page_id are all responses; a null page_id is written
without an id and comes back as null, a response only if no equal payload has
an id; an empty table gives no archive and no rows; other columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ballotlens.llm import common as C

ARCHIVE_BYTES = 64 << 20            # payload bytes that a file holds on average at most
CRAWL_DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INFLATE_BYTES = 1 << 18
CHUNK_BYTES = 8 << 20               # members that are handed on together
LEVEL = 6
INDEX = ("archive string, offset long, length long, record_type string, page_id long, refers_to long, "
         "payload_bytes long, payload_digest string, target_uri string")


def _member(data: bytes, level: int = LEVEL) -> bytes:
    out = zlib.compressobj(level, zlib.DEFLATED, 31)
    return out.compress(data) + out.flush()


EMPTY_MEMBER = _member(b"")


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base 32 of a 40-digit hex string."""
    digits = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(value): the text of one WARC record per page, without its last CRLF."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumns(
        {"sha": F.sha1("html"), "bytes": F.octet_length("html").cast("long")})
    first = own.groupBy(F.col("sha").alias("first_sha"), F.col("bytes").alias("first_bytes")).agg(
        F.min("page_id").alias("first"))
    joined = own.join(first, (F.col("sha") == F.col("first_sha")) & (F.col("bytes") == F.col("first_bytes")))
    revisit = (F.col("bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    maybe = lambda name, value: F.coalesce(line(name, value), F.lit(""))  # noqa: E731  no line for null
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    line("Content-Length", F.col("bytes")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    key = F.md5(F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit(" "), F.col("sha")))
    uuid = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return joined.select(F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))),
        line("WARC-Date", F.lit(CRAWL_DATE)),
        maybe("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha")))),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))).otherwise(F.lit("")),
        F.when(revisit, line("X-Refers-To-Page", F.col("first"))).otherwise(F.lit("")),
        maybe("X-Page-Id", F.col("page_id")),
        line("X-Payload-Length", F.col("bytes")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"), block, F.lit("\r\n")).alias("value"))


def write_monolithic(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Archives of one gzip stream each. Files are cut at a number of records
    that follows from the mean payload."""
    size = pages.agg(F.avg(F.octet_length(F.col("html").cast("string")))).first()[0] or 0
    (records(pages, min_revisit_bytes).write.option("compression", "gzip").option("lineSep", "\r\n")
     .option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / (size + 1024)))).text(path))


def inflate_records(data: bytes) -> Iterator[bytes]:
    """The records of a gzip file, whatever its members, inflated as one stream
    of bounded pieces; only the record in hand is held."""
    stream, held, view = zlib.decompressobj(31), bytearray(), memoryview(data)
    need, at = None, 0

    def pieces() -> Iterator[bytes]:
        nonlocal stream, at
        while at < len(view):
            raw = view[at:at + INFLATE_BYTES]
            at += len(raw)
            while raw:
                yield stream.decompress(raw)
                if not stream.eof:
                    break
                raw, stream = stream.unused_data, zlib.decompressobj(31)

    for piece in pieces():
        held += piece
        while True:
            if need is None:
                head = held.find(b"\r\n\r\n")
                if head < 0:
                    break
                need = head + 4 + int(header_fields(bytes(held[:head]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends inside a record")


def header_fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def line(members: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["members"])

    for batch in batches:
        for content in batch.column("content"):
            members, size = [], 0
            for record in inflate_records(content.as_py()):
                members.append(_member(record))
                size += len(members[-1])
                if size > CHUNK_BYTES:
                    yield line(members)
                    members, size = [], 0
            if members:
                yield line(members)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Every gzip file of ``source`` rewritten in ``target`` with one member per record."""
    members = _files(spark, source).select("content").mapInArrow(_rewrite, "members binary")
    (members.select(F.col("members").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(target))


def walk_members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, inflated bytes) of each member that holds anything."""
    at, view = 0, memoryview(data)
    while at < len(view):
        stream, out, to = zlib.decompressobj(31), [], at
        while not stream.eof:
            if to >= len(view):
                raise ValueError("the archive ends inside a member")
            out.append(stream.decompress(view[to:to + INFLATE_BYTES]))
            to = min(len(view), to + INFLATE_BYTES)
        to -= len(stream.unused_data)
        if record := b"".join(out):
            yield at, to - at, record
        at = to


def _split(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = header_fields(head)
    return fields, rest[:int(fields["content-length"])].partition(b"\r\n\r\n")[2]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda text: int(text) if text is not None else None
    names = [c.split()[0] for c in INDEX.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in INDEX.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = []
            for offset, length, record in walk_members(content.as_py()):
                fields, payload = _split(record)
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                size = number(fields["x-payload-length"])
                if kind == "response":
                    size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != digest:
                        raise ValueError(f"{path} at {offset}: the payload does not match its digest")
                rows.append((path, offset, length, kind, number(fields.get("x-page-id")),
                             number(fields.get("x-refers-to-page")), size, digest, fields.get("warc-target-uri")))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def index_archives(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """The sidecar index of the archives in ``path``, written to ``index_path``
    and read from there. Every response's payload is checked against its digest."""
    _files(spark, path).select("path", "content").mapInArrow(_index, INDEX).write.parquet(index_path)
    return spark.read.schema(INDEX).parquet(index_path)


def read_records(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """The index rows with ``html``: each archive is opened once, and only the
    indexed members are inflated. A revisit has no payload of its own (null)."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for content, rows in zip(batch.column("content"), batch.column("rows").to_pylist()):
                data = content.as_py()
                for r in rows:
                    record = zlib.decompress(data[r["offset"]:r["offset"] + r["length"]], 31)
                    out.append(dict(r, html=_split(record)[1].decode() if r["record_type"] == "response" else None))
            yield pa.RecordBatch.from_pylist(out, schema=target)
    target = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64())
                        for c in f"{INDEX}, html string".split(", ")])
    by_file = index.groupBy("archive").agg(F.collect_list(F.struct(*index.columns)).alias("rows"))     # one file's records
    return (_files(spark, path).join(by_file, F.col("path") == F.col("archive")).select("content", "rows")
            .mapInArrow(fetch, INDEX + ", html string"))


def archive_pages(pages: DataFrame, min_revisit_bytes: int = 0) -> tuple[str, DataFrame]:
    """Pages written to archives in the shared folder, normalised and indexed:
    the folder of the normalised archives and the index read from its sidecar."""
    spark = pages.sparkSession
    base = C.fresh_path(spark, "warc")
    write_monolithic(pages, f"{base}/monolithic", min_revisit_bytes)
    normalise(spark, f"{base}/monolithic", f"{base}/archives")
    return f"{base}/archives", index_archives(spark, f"{base}/archives", f"{base}/index")
