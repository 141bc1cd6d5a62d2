"""WARC archives: writing, reading, and replacing repeated payloads by revisit records.

Archives are gzip files written by Spark's own writer: a record is one row of text, and the two line ends that close
it are the row separator. So they appear with the writer's commit and in any file system that Spark knows.

Revisits: the headers alone are shuffled by payload digest; the smallest page id of each digest is found by an
aggregation, joined back, and the archives are written anew, with payloads for responses and references for revisits.
"""

from __future__ import annotations

import gzip
import io
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrue.sources.shared import CLEAN_UP, written

FILE_BYTES = 32 << 20  # of payload, before compression
DATE = "1970-01-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in base32: eight times 20 bits, four digits each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line ends in the value become blanks."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.translate(value.cast("string"), "\r\n", "  "), F.lit(END)), F.lit(""))


def _write(records: DataFrame, path: str) -> None:
    """Write records (type, record_id, page_id, uri, date, digest, refers_*, payload_bytes, payload) as archives."""
    spark = records.sparkSession
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END + END))
    length = F.length(http) + F.coalesce(F.octet_length("payload"), F.lit(0))
    revisit = F.col("type") == "revisit"
    head = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _field("WARC-Type", F.col("type")),
        _field("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Target-URI", F.col("uri")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), "refers_record", F.lit(">")))),
        _field("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_uri"))),
        _field("WARC-Refers-To-Date", F.when(revisit, F.col("refers_date"))),
        _field("Page-ID", F.col("page_id")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", length),
        F.lit(END),
        http,
    )
    body = F.concat(F.encode(head, "UTF-8"), F.coalesce("payload", F.lit(b"")))
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        records.select(body.cast("string").alias("value")).write.option("lineSep", END + END).option("compression", "gzip").text(path)
    finally:
        spark.conf.set(CLEAN_UP, before)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", uri: str = "url", html: str = "html", date: str = DATE, file_bytes: int = FILE_BYTES) -> None:
    """A response record for every row of `pages`, in files of about `file_bytes` payload.

    The payload is the html in UTF-8, empty for null. Rows without page id or uri lack that header line.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("string").alias("page_id"), F.col(uri).alias("uri"), payload.alias("payload"))
    total = rows.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    rows = rows.repartition(max(1, -(-total // file_bytes)), "page_id", "uri").withColumn("digest", base32_sha1(F.col("payload")))
    name = F.md5(F.to_json(F.struct("page_id", "uri", "digest")).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    absent = F.lit(None).cast("string")
    records = rows.select(
        "*",
        F.lit("response").alias("type"),
        F.concat(F.lit("urn:uuid:"), uuid).alias("record_id"),
        F.lit(date).alias("date"),
        absent.alias("refers_record"),
        absent.alias("refers_uri"),
        absent.alias("refers_date"),
        F.octet_length("payload").alias("payload_bytes"),
    )
    _write(records, path)


_FIELDS = {"type": "WARC-Type", "record_id": "WARC-Record-ID", "date": "WARC-Date", "uri": "WARC-Target-URI", "digest": "WARC-Payload-Digest", "page_id": "Page-ID", "refers_record": "WARC-Refers-To"}


def _head(stream: IO[bytes]) -> dict[str, str]:
    """Fields up to the empty line; names in lower case."""
    fields = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _records(stream: IO[bytes]) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Header fields, payload and declared payload length of each response and revisit; other records are passed over.

    One record is held at a time. A payload is what follows the HTTP head; a block that is no HTTP message is one as a whole.
    """
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record begins with {line[:20]!r}")
        fields = _head(stream)
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} has another length than it says")
        if fields.get("warc-type") not in ("response", "revisit"):
            continue
        body = io.BytesIO(block)
        declared = None
        if block.startswith(b"HTTP/"):
            declared = _head(body).get("content-length")
        payload = block[body.tell() :]
        yield fields, payload, int(declared) if declared else len(payload)


def read_archives(spark: SparkSession, path: str, kind: T.DataType | str = "long", with_payload: bool = False) -> DataFrame:
    """One row per record: type, record_id, date, uri, digest, page_id, refers_record, payload_bytes[, payload].

    Payloads are checked against their digests (SHA-1; where there is none or one of another kind, it is computed). A revisit
    has no payload; its payload_bytes are those of the original, as far as it tells them. Files are gzip of one member or of
    one for each record; records of other types are passed over, and a record of another writer has no page_id.
    """
    names = [*_FIELDS, "payload_bytes", *["payload"] * with_payload]
    schema = pa.schema([*((n, pa.string()) for n in _FIELDS), ("payload_bytes", pa.int64()), *[("payload", pa.binary())] * with_payload])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                rows: list[tuple[object, ...]] = []
                size = 0
                # one member for the whole file, or one for each record
                for fields, payload, declared in _records(gzip.GzipFile(fileobj=pa.BufferReader(file.as_buffer()))):
                    told = {k: fields.get(v.lower()) for k, v in _FIELDS.items()}
                    method, _, digest = (told["digest"] or "").rpartition(":")
                    if told["type"] == "response":
                        own = b32encode(sha1(payload).digest()).decode()
                        if method in ("", "sha1") and digest and digest.upper() != own or len(payload) != declared and "page-id" in fields:
                            raise ValueError(f"record {told['record_id']} is damaged")
                        digest, declared = own, len(payload)
                    told |= {"digest": digest, "record_id": (told["record_id"] or "")[1:-1], "refers_record": told["refers_record"] and told["refers_record"][1:-1]}
                    rows.append((*told.values(), declared, *[bytes(payload)] * with_payload))
                    size += len(payload) * with_payload
                    if size > 8 << 20 or len(rows) == 10_000:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).where("length > 0").select("content")
    spec = ", ".join(f"{n} {'long' if n == 'payload_bytes' else 'binary' if n == 'payload' else 'string'}" for n in names)
    return files.mapInArrow(parse, spec).withColumn("page_id", F.col("page_id").cast(kind))


def deduplicate_archives(spark: SparkSession, path: str, to: str, kind: T.DataType | str = "long", least_bytes: int = 0) -> None:
    """Write the archives anew: of equal payloads of at least `least_bytes`, all but the smallest page id's are revisits.

    Smaller payloads stay responses. Rows that repeat the smallest page id are responses as well; a record without page
    id is a revisit where another one has an id, else a response.
    """
    headers = written(read_archives(spark, path, kind), "headers")
    first = headers.where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes").agg(F.min("page_id").alias("least"))
    origin = headers.select(F.col("digest"), F.col("page_id").alias("least"), F.col("record_id").alias("refers_record"), F.col("uri").alias("refers_uri"), F.col("date").alias("refers_date"))
    # a repeated response: one of its records is referred to
    origin = first.join(origin, ["digest", "least"]).groupBy("digest", "payload_bytes", "least").agg(F.min(F.struct("refers_record", "refers_uri", "refers_date")).alias("of"))
    later = headers.join(origin, ["digest", "payload_bytes"]).where(~F.col("page_id").eqNullSafe(F.col("least")))
    later = later.select("record_id", "of.*").dropDuplicates(["record_id"])
    records = read_archives(spark, path, kind, with_payload=True).drop("refers_record").join(later, "record_id", "left")
    revisit = F.col("refers_record").isNotNull()
    records = records.withColumn("type", F.when(revisit, "revisit").otherwise(F.col("type"))).withColumn("payload", F.when(~revisit, F.col("payload")))
    fresh = F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws(" ", "type", "record_id").cast("binary")), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"))
    fresh_of = F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws(" ", F.lit("response"), "refers_record").cast("binary")), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"))
    _write(records.withColumn("record_id", fresh).withColumn("refers_record", F.when(revisit, fresh_of)), to)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records of deduplicated archives, revisits joined to their original responses.

    (page_id, payload_bytes, payload_digest, record_type, refers_to): length and digest of the full payload, and the page
    id of the response that a revisit refers to.
    """
    records = written(records, "records")
    original = records.where("type = 'response'").select(F.col("record_id").alias("refers_record"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("digest").alias("of")).dropDuplicates(["refers_record"])
    revisits = records.where("type = 'revisit'").join(original, "refers_record", "left")
    revisits = revisits.select("page_id", F.coalesce("n", "payload_bytes").alias("payload_bytes"), F.coalesce("of", "digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    absent = F.lit(None).cast(records.schema["page_id"].dataType)
    rest = records.where("type != 'revisit'").select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), absent.alias("refers_to"))
    return rest.union(revisits)
