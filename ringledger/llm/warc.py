"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is written as three records: a request, a response (or a revisit, if an earlier capture has the same
payload) and metadata; request and metadata name the response's record in WARC-Concurrent-To. Archives are
written by Spark's own text writer: a record's bytes are the line and the blank line that ends a record is the
separator, so retries and lost executors are handled as for any table. Reading parses by Content-Length, so a
payload may hold anything, the separator and a version line included.

``assemble`` joins the records of any archives, wherever they were read from: the record each WARC-Concurrent-To
points at may be a response or another record of the transaction, and the link may point either way.

Defined results: a null html is an empty payload; a null page id sorts after all others and is written without
that field; of rows with equal payload and page id one is the response; a null url is an empty target; repeated
rows are captures of their own; an empty table gives archives without records. Columns other than page_id, url
and html are not read. Rows are told apart by their place, so pages are read from files, or ``stored``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm.components import spread_join

EPOCH = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
#: Records of an archive, at most; three per capture.
RECORDS_PER_ARCHIVE = 15_000

RECORD_SCHEMA = (
    "record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "payload_digest string, page_id long, header map<string,string>, http_header string, payload binary, "
    "payload_bytes long, computed_digest string"
)


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: ten hex digits at a time are eight digits to base 32, then renamed."""
    digest = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(*parts: Column | str) -> Column:
    """A urn:uuid drawn from the parts."""
    h = F.md5(F.concat_ws("/", *parts))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(fields: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """A whole record but for the two line ends after its block; a field with a null value is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]
    lines += [
        F.lit(f"Content-Type: {content_type}{CRLF}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF)),
    ]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), *[F.coalesce(line, F.lit("")) for line in lines], F.lit(CRLF), block)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The pages with ``row``, ``digest``, and ``first_row``, the row of the response this capture revisits, or null.

    Of pages with equal payloads of at least ``min_bytes``, the one with the smallest id is the response. The
    payload takes part in one exchange, by digest, in a join that Spark may split where one payload is common.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "digest": sha1_base32(F.col("html"))})
    order = F.struct(F.col("page_id").isNull().alias("late"), "page_id", "row")
    first = (
        rows.where(F.octet_length("html") >= min_bytes)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    joined = spread_join(rows, first, "digest", "left")
    is_first = F.col("first").isNull() | (F.col("first.row") == F.col("row"))
    return joined.withColumn("first_row", F.when(~is_first, F.col("first.row"))).select(
        "row", "page_id", "url", "html", "digest", "first_row", F.when(~is_first, F.col("first.page_id")).alias("first_page")
    )


def records(captures: DataFrame) -> DataFrame:
    """One column ``value``: the text of every record of every capture.

    Record ids are drawn from the capture's row and a name that every call makes anew, so that those of other
    crawls are others.
    """
    crawl = F.lit(uuid.uuid4().hex)

    def text(column: Column) -> Column:
        return F.regexp_replace(column, r"[\r\n]", " ")

    row = F.concat_ws("/", crawl, F.col("row").cast("string"))
    response_id = _record_id(F.lit("response"), row)
    uri = F.when(F.col("url") != "", text(F.col("url")))
    host = F.coalesce(F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract("url", r"^[a-z]+://[^/?#]+([^#\r\n]*)", 1), F.lit("/"))
    common = [("WARC-Date", F.lit(EPOCH)), ("WARC-Target-URI", uri)]
    links = [*common, ("WARC-Concurrent-To", response_id)]
    revisit = F.col("first_row").isNotNull()
    payload_digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(CRLF * 2),
    )
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _record_id(F.lit("request"), row)), *links],
        "application/http; msgtype=request",
        F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2)),
    )
    response = _record(
        [("WARC-Type", F.lit("response")), ("WARC-Record-ID", response_id), *common, payload_digest],
        "application/http; msgtype=response",
        F.concat(http, F.col("html")),
    )
    again = _record(
        [
            ("WARC-Type", F.lit("revisit")),
            ("WARC-Record-ID", response_id),
            *common,
            payload_digest,
            ("WARC-Refers-To", _record_id(F.lit("response"), F.concat_ws("/", crawl, F.col("first_row").cast("string")))),
            ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ],
        "application/http; msgtype=response",
        http,
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _record_id(F.lit("metadata"), row)), *links],
        "application/warc-fields",
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")),
    )
    return captures.select(F.explode(F.array(request, F.when(revisit, again).otherwise(response), metadata)).alias("value"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write the pages as archives into a new folder."""
    writer = records(with_revisits(pages, min_bytes)).write.option("lineSep", CRLF * 2)
    writer.option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).option("compression", "gzip").text(folder)


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header fields, by lower-case name, and block of every record of an archive's bytes."""
    held, ended = bytearray(), False

    def fill(size: int) -> bool:
        nonlocal ended
        while len(held) < size and not ended:
            chunk = next(chunks, None)
            if chunk is None:
                ended = True
            else:
                held.extend(chunk)
        return len(held) >= size

    while True:
        size = 0
        while (at := held.find(b"\r\n\r\n", max(0, size - 4))) < 0 and fill(size := len(held) + 1):
            pass
        # Between records there is nothing but line ends.
        start = len(held) - len(held.lstrip(b"\r\n"))
        if 0 <= at < start:
            del held[:start]
            continue
        if at < 0:
            if held[start:]:
                raise ValueError("an archive ends within a record's header")
            return
        lines = held[start:at].decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        fields: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        length = int(fields["content-length"][0])
        if not fill(at + 4 + length):
            raise ValueError("an archive ends within a record's block")
        yield fields, bytes(held[at + 4 : at + 4 + length])
        del held[: at + 4 + length]


def _inflated(content: bytes) -> Iterator[bytes]:
    """The bytes of a plain archive, or of a gzip one with any number of members, in bounded chunks."""
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), 1 << 20):
            yield content[at : at + (1 << 20)]
        return
    rest = content
    while rest:
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            chunk = member.decompress(rest, 1 << 20)
            rest = member.unconsumed_tail
            if chunk:
                yield chunk
            elif not rest and not member.eof:
                raise ValueError("a compressed archive ends early")
        rest = member.unused_data.lstrip(b"\0")


def _row(fields: dict[str, list[str]], block: bytes, with_payload: bool) -> dict:
    def one(name: str) -> str | None:
        return fields.get(name, [None])[0]

    kind, content_type = one("warc-type"), one("content-type") or ""
    http, payload = None, block
    if content_type.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
    page = None
    if kind == "metadata" and content_type == "application/warc-fields":
        for line in block.decode("utf-8", "replace").split(CRLF):
            name, _, value = line.partition(":")
            page = int(value) if name == "page-id" else page
    full = kind in ("response", "resource")
    digest = (one("warc-payload-digest") or "").removeprefix("sha1:") or None
    return {
        "record_id": one("warc-record-id"),
        "type": kind,
        "target_uri": one("warc-target-uri"),
        "date": one("warc-date"),
        "concurrent_to": fields.get("warc-concurrent-to", []),
        "refers_to": one("warc-refers-to"),
        "payload_digest": digest,
        "page_id": page,
        "header": [(name, ", ".join(values)) for name, values in fields.items()],
        "http_header": http,
        "payload": payload if with_payload else None,
        "payload_bytes": len(payload) if full else None,
        "computed_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if full else None,
    }


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives in a folder; ``with_payload`` off leaves the payloads' bytes behind.

    An archive is held compressed by one task and inflated in chunks; records leave in small batches.
    """
    arrow = pa.schema(
        [
            *[(n, pa.string()) for n in ("record_id", "type", "target_uri", "date")],
            ("concurrent_to", pa.list_(pa.string())),
            ("refers_to", pa.string()),
            ("payload_digest", pa.string()),
            ("page_id", pa.int64()),
            ("header", pa.map_(pa.string(), pa.string())),
            ("http_header", pa.string()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("computed_digest", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parse(_inflated(content.as_py())):
                    rows.append(_row(fields, block, with_payload))
                    held += len(block) if with_payload else 500
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(folder)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its request, and its metadata.

    Columns: record_id, type, target_uri, date, page_id, refers_to, payload_digest (declared, else computed),
    payload_bytes, payload, http_header, request (struct, the one with the smallest id), metadata (array of
    structs by id). A record is part of a capture if a link leads from one to the other, directly or over one more
    record of the same transaction. Records that no link connects to a capture are left out.
    """
    anchors = found.where(F.col("type").isin("response", "revisit", "resource"))
    parts = found.where(~F.col("type").isin("response", "revisit", "resource", "warcinfo"))
    part = F.struct("record_id", "type", "page_id", "http_header", "header")
    outgoing = parts.select(F.col("record_id").alias("part_id"), F.explode("concurrent_to").alias("to"))
    anchor_ids = anchors.select(F.col("record_id").alias("to"))
    straight = outgoing.join(anchor_ids, "to").select("part_id", F.col("to").alias("anchor"))
    back = anchors.select(F.col("record_id").alias("anchor"), F.explode("concurrent_to").alias("part_id"))
    direct = straight.unionByName(back.select("part_id", "anchor"))
    onward = (
        outgoing.join(anchor_ids, "to", "left_anti")
        .join(direct.select(F.col("part_id").alias("to"), "anchor"), "to")
        .select("part_id", "anchor")
    )
    links = direct.unionByName(onward).distinct()
    members = links.join(parts.select(F.col("record_id").alias("part_id"), part.alias("part")), "part_id")
    grouped = members.groupBy("anchor").agg(
        F.min(F.when(F.col("part.type") == "request", F.struct("part.record_id", "part.http_header"))).alias("request"),
        F.array_sort(
            F.collect_list(F.when(F.col("part.type") == "metadata", F.struct("part.record_id", "part.page_id")))
        ).alias("metadata"),
    )
    return anchors.join(grouped, F.col("record_id") == F.col("anchor"), "left").select(
        "record_id",
        "type",
        "target_uri",
        "date",
        F.get(F.col("metadata.page_id"), F.lit(0)).alias("page_id"),
        "refers_to",
        F.coalesce("payload_digest", "computed_digest").alias("payload_digest"),
        "payload_bytes",
        "payload",
        "http_header",
        "request",
        F.coalesce("metadata", F.array().cast("array<struct<record_id:string,page_id:bigint>>")).alias("metadata"),
    )


def resolved(captures: DataFrame) -> DataFrame:
    """The captures with ``payload_bytes`` of the full payload and ``refers_to_page``, for revisits from their response.

    A capture that refers to nothing is looked up by its own id, so that those do not meet in one task.
    """
    responses = captures.where("type = 'response'").select(
        F.col("record_id").alias("_target"), F.col("payload_bytes").alias("full_bytes"), F.col("page_id").alias("target_page")
    )
    joined = spread_join(captures.withColumn("_target", F.coalesce("refers_to", "record_id")), responses, "_target", "left")
    return (
        joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "full_bytes"))
        .withColumn("refers_to_page", F.when(F.col("refers_to").isNotNull(), F.col("target_page")))
        .drop("full_bytes", "target_page", "_target")
    )
