"""WARC archives whose repeated payloads are revisit records.

Headers (digest, id, length) are shuffled by payload digest to find the record
that stays a response: of equal payloads of `least` bytes or more, the one with
the largest id. The others are written as revisits that refer to it. Archives
are gzip files written by Spark's text writer: a WARC record ends with two line
ends, so they serve as the writer's line separator. Files stay small because
AQE sizes the tasks that write them and `FILE_ROWS` bounds their records.

Reading back goes by Content-Length, record by record, and revisits are joined
to their responses by record id. Both joins meet a hot digest as plain shuffles
that AQE splits.

Defined cases: a null payload is empty; a null URL is written as `about:blank`;
all rows that carry the largest id of a payload are responses; a row without id
never is what others refer to, and in a group without any id all are responses.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BYTES = 1000
FILE_ROWS = 4000
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id LONG, record_type STRING, record_id STRING, refers_to_id STRING, payload_digest STRING, payload_bytes LONG, uri STRING, payload BINARY"


def resolve(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, uri, html, digest, bytes, refers_to (null: a response)."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("about:blank")).alias("uri"),
        body.alias("html"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("bytes"),
    )
    large = rows.where(F.col("bytes") >= least)
    stays = large.groupBy("digest").agg(F.max("page_id").alias("stays"), F.count(F.lit(1)).alias("n"))
    twice = stays.where("n > 1").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("stays")), F.col("stays"))
    return (
        large.join(twice, "digest", "left").select(*rows.columns, refers.alias("refers_to"))
        .unionByName(rows.where(F.col("bytes") < least).withColumn("refers_to", F.lit(None).cast("long")))
    )


def record_id(page_id: Column) -> Column:
    """A UUID made from the id alone, so a revisit can name its response without meeting it."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("none"))).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def records(resolved: DataFrame) -> DataFrame:
    """value: each record with fresh headers, without the two line ends that close it."""
    again = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(CRLF * 2),
    )
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    # A line end inside a URL would end the header.
    uri = F.regexp_replace("uri", r"[\r\n]", "")
    return resolved.select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"),
            head("WARC-Type", F.when(again, "revisit").otherwise("response")),
            head("WARC-Record-ID", record_id(F.col("page_id"))),
            head("WARC-Target-URI", uri),
            head("WARC-Date", F.lit(DATE)),
            head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(
                again,
                F.concat(head("WARC-Refers-To", record_id(F.col("refers_to"))), head("WARC-Profile", F.lit(REVISIT_PROFILE))),
            ).otherwise(""),
            F.when(F.col("page_id").isNotNull(), head("X-Page-ID", F.col("page_id").cast("string"))).otherwise(""),
            head("Content-Type", F.lit("application/http; msgtype=response")),
            head("Content-Length", F.octet_length(block).cast("string")),
            F.lit(CRLF),
            block,
        ).alias("value")
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Writes every page as a record of gzip-compressed archives under `path`."""
    (
        records(resolve(pages, least)).write.option("lineSep", CRLF * 2).option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_ROWS).text(path)
    )


def unzipped(data: bytes) -> bytes:
    """All gzip members of a file, one after another."""
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple]:
    """The records of one archive; payloads of responses are bytes of the archive, not of its headers."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *fields = data[at:end].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.lower(): v for k, v in (f.split(": ", 1) for f in fields)}
        n = int(head["content-length"])
        block = data[end + 4 : end + 4 + n]
        if len(block) < n:
            raise ValueError(f"the record at byte {at} is cut off")
        http, _, payload = block.partition(b"\r\n\r\n")
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        page = head.get("x-page-id")
        yield (
            None if page is None else int(page), head["warc-type"], head["warc-record-id"], head.get("warc-refers-to"),
            head["warc-payload-digest"].removeprefix("sha1:"), length, head["warc-target-uri"],
            payload if head["warc-type"] == "response" else None,
        )
        at = end + 4 + n + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under `path`, as in RECORD."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = {"LONG": pa.int64(), "STRING": pa.string(), "BINARY": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RECORD.split(", ")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = list(parse(unzipped(content.as_py())))
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(each, RECORD)


def link(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, intact: revisits joined to their responses.

    Length and digest of a response come from the payload read, of a revisit
    from its headers; `intact` says whether payload and headers agree.
    """
    answers = found.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    ).distinct()
    response = F.col("record_type") == "response"
    revisits = found.where("record_type = 'revisit'").join(answers, "refers_to_id", "left")
    whole = found.where(response).withColumn("refers_to", F.lit(None).cast("long"))
    digest = F.when(response, F.sha1("payload")).otherwise(F.col("payload_digest"))
    length = F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes"))
    return whole.unionByName(revisits.select(*whole.columns)).select(
        "page_id", length.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to",
        ((digest == F.col("payload_digest")) & (length == F.col("payload_bytes"))).alias("intact"),
    )
