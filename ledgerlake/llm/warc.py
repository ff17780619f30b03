"""WARC archives (operator 2): writing captures, and assembling transactions on reading.

A capture is three records: the request, the response (or a revisit of an
equal payload), and metadata. The request and the metadata name the response
in WARC-Concurrent-To. Spark's text writer makes the files: a record is one
string, and the line separator is the CRLF that ends a record, so a file is a
valid gzip-compressed WARC file; ``records_per_file`` bounds a file's size.
Reading parses whole files by Content-Length in each task, then joins request,
response and metadata on the response's record id and emits one nested row per
capture.

Of captures with equal payloads of at least ``MIN_REVISIT`` bytes the one with
the smallest page_id is the response, the others revisit it. A payload's rows
are pre-aggregated by digest, and only digests with several rows are joined
back, dealt over salts.

Defined results: a null payload is empty; a null URL gives no
WARC-Target-URI; control characters and blanks in a URL are percent-encoded in
headers; captures with the smallest page_id of their payload are all
responses if the row is repeated; a null page_id never becomes the original of
others, and comes back null; equal rows come back as often as they were
written.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import salted_join

MIN_REVISIT = 100
RECORDS_PER_FILE = 6000
_EOL = "\r\n"
#: Fixed value: the profile of a revisit record for an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing -----------------------------------------------------------------


def _lines(*parts: Column | str) -> Column:
    """Header lines, each ended by CRLF; a null line is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(p) if isinstance(p, str) else p, F.lit(_EOL)),
                                 F.lit("")) for p in parts])


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _record(kind: str | Column, identity: Column, block: Column, *more: Column | str) -> Column:
    """A record without its last CRLF, which the writer adds."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(
        _lines("WARC/1.1", _field("WARC-Type", kind), _field("WARC-Record-ID", identity),
               _field("WARC-Date", F.lit("2024-01-01T00:00:00Z")), *more,
               _field("Content-Length", F.octet_length(block).cast("string"))),
        F.lit(_EOL), block, F.lit(_EOL))


def _identity(kind: str, *values: Column) -> Column:
    """A record id made from the capture's own values, the same at every run."""
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), *[F.coalesce(v.cast("string"), F.lit("\x1e"))
                                                  for v in values]))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header_safe(url: Column) -> Column:
    """Control characters and blanks percent-encoded, so that a URL stays on its line."""
    out = url
    for code in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), out).otherwise(url)


def with_roles(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest and ``original`` (page_id of the response it revisits)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    several = (rows.where(F.octet_length("payload") >= min_revisit).groupBy("digest")
               .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
               .where("n > 1 and first is not null").select("digest", "first"))
    joined = salted_join(rows.withColumn("_spread", F.xxhash64("page_id", "url")), several,
                         ["digest"], "_spread", "left")
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
                         .alias("original"))


def records(captures: DataFrame) -> DataFrame:
    """The three records of each capture (``value``), from :func:`with_roles`."""
    own = [F.col("page_id"), F.col("url"), F.col("digest")]
    uri = _field("WARC-Target-URI", _header_safe(F.col("url")))
    digest = _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    size = F.octet_length("payload").cast("string")
    http = F.concat(_lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
                           _field("Content-Length", size)), F.lit(_EOL))
    revisit = F.col("original").isNotNull()
    main = _identity("response", *own)
    together = _field("WARC-Concurrent-To", main)
    target = F.regexp_extract(_header_safe(F.col("url")), r"^.*?://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract(_header_safe(F.col("url")), r"^.*?://([^/?#]*)", 1)
    request = F.concat(
        F.lit("GET "), F.when(target == "", F.lit("/")).otherwise(F.coalesce(target, F.lit("/"))),
        F.lit(" HTTP/1.1" + _EOL), _lines(_field("Host", F.coalesce(host, F.lit("")))),
        F.lit(_EOL))
    about = _lines(_field("page-id", F.col("page_id").cast("string")),
                   _field("original-page-id", F.col("original").cast("string")))
    http_type = "Content-Type: application/http;msgtype="
    return captures.select(F.explode(F.array(
        _record("request", _identity("request", *own), request, uri, together,
                http_type + "request"),
        _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), main,
                F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))),
                uri, digest,
                F.when(revisit, F.lit("WARC-Profile: " + PROFILE)),
                http_type + "response"),
        _record("metadata", _identity("metadata", *own), about, uri, together,
                "Content-Type: application/warc-fields"),
    )).alias("value"))


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE,
                   min_revisit: int = MIN_REVISIT) -> None:
    """WARC files of ``pages`` (``page_id``, ``url``, ``html``) under ``path``."""
    (records(with_roles(pages, min_revisit)).write
     .option("lineSep", _EOL).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


# --- reading -----------------------------------------------------------------

_NAMED = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def unpack(content: bytes) -> bytes:
    """A file's bytes; gzip members, one or many, are expanded."""
    out = []
    while content[:2] == b"\x1f\x8b":
        state = zlib.decompressobj(31)
        out.append(state.decompress(content) + state.flush())
        content = state.unused_data
    return b"".join(out) + content


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        head = data[data.index(b"\r\n", at) + 2:end + 2]
        fields = {k.decode().lower(): v.decode() for k, v in _NAMED.findall(head)}
        at = end + 4 + int(fields["content-length"])
        yield fields, data[end + 4:at]


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``.

    A response's digest and size are those of the payload that was read; a
    digest that differs from its header fails the job. ``payloads=False``
    leaves the payload itself out.
    """
    names = ["kind", "record_id", "concurrent_to", "uri", "block", "digest", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, block in parse(unpack(content.as_py())):
                    kind = head["warc-type"]
                    digest = head.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    size, text = None, block
                    if kind in ("response", "revisit"):
                        http, _, text = block.partition(b"\r\n\r\n")
                        inner = {k.decode().lower(): v for k, v in _NAMED.findall(http + b"\r\n")}
                        size = int(inner["content-length"])
                        if kind == "response":
                            size = len(text)
                            found = hashlib.sha256(text).hexdigest()
                            if digest not in (None, found):
                                raise ValueError(f"payload digest of {head['warc-record-id']}")
                            digest = found
                    shown = text.decode() if payloads or kind == "metadata" else None
                    rows.append((kind, head["warc-record-id"], head.get("warc-concurrent-to"),
                                 head.get("warc-target-uri"), shown, digest, size))
                kinds = [*[pa.string()] * 6, pa.int64()]
                for a in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows[a:a + 500]), kinds)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "kind string, record_id string, concurrent_to string, uri string, "
                                 "block string, digest string, size long")


def transactions(rows: DataFrame) -> DataFrame:
    """One nested row per capture: uri, response, request and metadata, joined by record id."""
    main = rows.where("kind in ('response', 'revisit')").select(
        F.col("record_id").alias("id"), "uri",
        F.struct("kind", "digest", "size", F.col("block").alias("payload")).alias("response"))

    def partner(kind: str) -> DataFrame:
        # equal captures share a record id, and their requests and metadata are equal too
        return (rows.where(F.col("kind") == kind).groupBy(F.col("concurrent_to").alias("id"))
                .agg(F.first(F.struct("record_id", "block")).alias(kind)))

    meta = F.col("metadata.block")

    def number(name: str) -> Column:
        found = F.regexp_extract(meta, rf"(?:^|\n){name}: (-?[0-9]+)\r\n", 1)
        return F.when(found != "", found).cast("long")

    return (main.join(partner("request"), "id", "left").join(partner("metadata"), "id", "left")
            .select("id", "uri", "response", "request", F.struct(
                F.col("metadata.record_id").alias("record_id"),
                number("page-id").alias("page_id"),
                number("original-page-id").alias("original_page_id")).alias("metadata")))


def digest_rows(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each capture."""
    return captures.select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("response.size").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.col("metadata.original_page_id").alias("refers_to"))
