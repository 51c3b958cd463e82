"""WARC archives: written by Spark's text writer, read by a Python data source.

A record is a string that ends with the blank lines that separate records, so an archive is a text
file with ``\\r\\n\\r\\n`` as its line end, committed by Spark's own protocol and compressed on the
way. The data source ``warc`` plans one partition per group of files, takes predicates on record
type and on headers, parses headers first and decodes a payload only for records that pass and
only if payloads are asked for. It reads archives of other writers too: any record type and id, bodies
of any encoding, chunked bodies, gzip files with a member per record.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from tallyloom.llm.common import read, scratch_path, small_batches

_END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of all records: the tables hold none, and equal input gives equal archives.
DATE = "2024-01-01T00:00:00Z"
#: Records of one archive, and bytes of archives that one task reads.
FILE_RECORDS = 20_000
PARTITION_BYTES = 64 << 20
#: Longest line of headers; what is longer is no archive.
LINE_BYTES = 1 << 20
_PAGE = re.compile(r"<urn:page:(-?\d{1,19})>")

SCHEMA = (
    "record_type string, record_id string, page_id long, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to_id string, refers_to long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in base 32, upper case: eight groups of twenty bits."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def write_warc(
    pages: DataFrame, path: str, revisit_bytes: int = 0, compression: str = "gzip"
) -> None:
    """Write a record per row of pages (page_id, url, html).

    Of equal payloads of at least ``revisit_bytes`` bytes the row with the largest page_id is a
    response and the others revisit it without their payload. A null html is an empty payload, a
    null url an empty target. Rows that share page_id and payload are responses alike if theirs is
    the largest page_id; a null page_id is smaller than any. Line ends in a url become blanks. An
    empty table gives an archive without records; other columns are not read.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", " ").alias("url"),
        payload.alias("payload"), base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"),
    )
    repeated = (
        pages.select("page_id", base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
        .where(F.col("bytes") >= revisit_bytes)
        .groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    typed = rows.join(repeated, "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    block = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nWARC-X-Payload-Length: "), F.col("bytes").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), _urn(F.col("original")),
                                 F.lit(f"\r\nWARC-Profile: {_PROFILE}"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    writer = typed.select(F.concat(head, block).alias("value")).write.option("lineSep", _END)
    writer.option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS).text(path)


class _Files(InputPartition):
    def __init__(self, files: list[str]) -> None:
        super().__init__(files)
        self.files = files


def _page(urn: str | None) -> int | None:
    """The page_id that an id written here holds; ids of other writers hold none."""
    held = _PAGE.fullmatch(urn or "")
    return int(held[1]) if held else None


def _dechunked(body: bytes) -> bytes:
    """A body sent in chunks, put together; as it is where it does not keep to that form."""
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        digits = body[at:end].partition(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", digits):
            return body
        size = int(digits, 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
        if at > len(body):
            return body
    return body


def _body(block: bytes, http: bool) -> bytes:
    """The payload of a record's block: what follows the HTTP headers, if it has any."""
    if not http:
        return block
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        head, gap, body = block.partition(b"\n\n")
    return _dechunked(body) if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head) else body


_TESTS = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool) -> None:
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters):  # noqa: N802
        """Take what headers can answer; payload predicates stay with Spark."""
        for f in filters:
            known = type(f) in _TESTS or isinstance(f, In | IsNotNull)
            if known and len(f.attribute) == 1 and f.attribute[0] != "payload":
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.is_file and f.base_name[0] not in "._")
        groups, held = [[]], 0
        for name, size in files:
            if groups[-1] and held + size > PARTITION_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(name)
            held += size
        return [_Files(g) for g in groups]

    def _passes(self, row: dict) -> bool:
        for f in self.filters:
            value = row[f.attribute[0]]
            if value is None:
                return False
            if isinstance(f, In):
                if value not in f.value:
                    return False
            elif not isinstance(f, IsNotNull) and not _TESTS[type(f)](value, f.value):
                return False
        return True

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in SCHEMA.split(", "))])
        system, _ = fs.FileSystem.from_uri(self.path)
        held, size = [], 0
        for name in partition.files:
            with system.open_input_stream(name, compression="detect") as raw:
                for row in self._records(io.BufferedReader(raw, 1 << 20), name):
                    held.append(row)
                    size += len(row["payload"] or "")
                    if len(held) >= 1000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    def _records(self, stream: io.BufferedReader, name: str) -> Iterator[dict]:
        while line := stream.readline(LINE_BYTES):
            if not line.strip():
                continue  # blank lines part the records
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{name}: no WARC record begins with {line[:40]!r}")
            headers = _headers(stream, name)
            kind, length = headers.get("warc-type"), headers.get("content-length", "")
            if not kind or not length.isdecimal():
                raise ValueError(f"{name}: a record without a type or a length: {headers}")
            length = int(length)
            http = headers.get("content-type", "").replace(" ", "").lower().startswith("application/http")
            # Without HTTP headers the block is the payload.
            stated = headers.get("warc-x-payload-length", "" if http or kind == "revisit" else str(length))
            row = {
                "record_type": kind,
                "record_id": headers.get("warc-record-id"),
                "page_id": _page(headers.get("warc-record-id")),
                "target_uri": headers.get("warc-target-uri"),
                "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                "payload_bytes": int(stated) if stated.isdecimal() else None,
                "refers_to_id": headers.get("warc-refers-to"),
                "refers_to": _page(headers.get("warc-refers-to")),
                "payload": None,
            }
            if not self._passes(row):
                _skip(stream, length, name)
                continue
            if self.payload and kind != "revisit":
                block = stream.read(length)
                if len(block) < length:
                    raise EOFError(f"{name} ends inside a record")
                row["payload"] = _body(block, http)
            else:
                _skip(stream, length, name)
            yield row


def _headers(stream: io.BufferedReader, name: str) -> dict[str, str]:
    """Header lines up to the blank one, by lower-case name; a line that begins blank goes on with the last."""
    headers, last = {}, None
    while True:
        line = stream.readline(LINE_BYTES)
        if not line.endswith(b"\n"):
            raise EOFError(f"{name} ends inside a record's headers")
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not text:
            return headers
        if text[0] in " \t" and last:
            headers[last] = f"{headers[last]} {text.strip()}".strip()
            continue
        last, _, value = text.partition(":")
        last = last.strip().lower()
        headers[last] = value.strip()


def _skip(stream: io.BufferedReader, n: int, name: str) -> None:
    while n > 0:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            raise EOFError(f"{name} ends inside a record")
        n -= got


class WarcSource(DataSource):
    """Options: path, a URI that pyarrow opens; payload, "false" to leave payloads undecoded."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI of the file system that Spark itself would take."""
    jvm = spark.sparkContext._jvm
    given = jvm.org.apache.hadoop.fs.Path(path)
    system = given.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(given).toUri().toString()


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives below a path, one row each, of any type and from any writer.

    ``record_id`` and ``refers_to_id`` are as written; ``page_id`` and ``refers_to`` are null where
    those are not ids of ``write_warc``. ``payload`` holds the bytes after the HTTP headers (with
    chunks put together) or the whole block of a record that has none; of revisits it is null.
    ``payload_bytes`` and ``payload_digest`` are what the headers state, null if they state nothing;
    a block without HTTP headers has its stated length. Digests other than SHA-1 keep their prefix.
    Header bytes that are no UTF-8 become replacement signs. A record without a type or length,
    bytes that are no record and an archive that ends inside one stop the job and name the file.
    Repeated records are repeated rows; empty files and folders give none.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    small_batches(spark)
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(_qualified(spark, path))


def op8_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    got = F.col("payload").isNotNull()
    return read_warc(spark, path).select(
        "page_id",
        # What was read back counts; a revisit has the figures of its headers alone.
        F.when(got, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(got, base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


_SQL = """
with digits as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    translate(list_aggregate(list_transform(range(0, 8), lambda i: to_base(
      ('0x' || substr(sha1(coalesce(html, '')), (1 + 5 * i)::int, 5))::bigint, 32, 4)), 'string_agg', ''),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest
  from pages
),
marked as (select *, max(page_id) over (partition by payload_digest) as original from digits)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when page_id = original then 'response' else 'revisit' end as record_type,
  case when page_id <> original then original end as refers_to
from marked
"""

QUERIES = {"op8_warc": (op8_warc, _SQL)}
