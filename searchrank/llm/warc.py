"""WARC archives with revisit resolution.

``write_archives`` shuffles only the headers (page id and payload digest)
by digest: of the records with equal payloads of at least ``min_bytes``
bytes the one with the smallest page id stays a ``response``; the others
become ``revisit`` records that name it.  Every record gets fresh headers
(record id, date, digest, lengths).  Records leave through Spark's text
writer, whose line separator is the record terminator, so the files are
plain WARC/1.1 (gzip compressed) in whatever store Spark writes to.
``read_archives`` parses them by Content-Length, and ``resolve`` joins the
revisits to their originals.

Files hold at most ``records_per_file`` records, which bounds what one
reading task holds.

Defined cases: null html is an empty payload; null url gives an empty
target; control characters in urls are percent-coded in headers; rows that
tie at the smallest page id are all responses; a null page id is never the
smallest (all null: all are responses); repeated rows keep their records;
an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchrank.llm.common import stage

MIN_BYTES = 100
#: Records in one file; the reader holds one file at a time.
RECORDS_PER_FILE = 4096
_CRLF = "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def _uuid(c: Column) -> Column:
    """A urn:uuid made from a hash of ``c`` (the same row always gets the same id)."""
    h = F.md5(c)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record_id(page: Column, digest: Column) -> Column:
    return _uuid(F.concat_ws(" ", F.coalesce(page.cast("string"), F.lit("null")), digest))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))


def _clean_url(c: Column) -> Column:
    c = F.coalesce(c.cast("string"), F.lit(""))
    for raw, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), ("\0", "%00")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def records(pages: DataFrame, date: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, html) -> one text column ``record``: header block and content block."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), _clean_url(F.col("url")).alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("bytes", F.octet_length("html"))
    heads = p.where(F.col("bytes") >= min_bytes).select("page_id", "url", "digest")
    first = stage(heads.groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("no"), "page_id", "url")).alias("first"),
        F.count("*").alias("n")).where("n > 1").select(
            "digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")), "originals")
    p = p.join(first, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit(_CRLF * 2))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    of = _record_id(F.col("first_id"), F.col("digest"))
    head = F.concat(
        F.lit("WARC/1.1" + _CRLF),
        _header("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        F.coalesce(_header("WARC-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(
            _header("WARC-Refers-To", of), _header("WARC-Refers-To-Target-URI", F.col("first_url")),
            _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")))
    return p.select(F.concat(head, F.lit(_CRLF), block).alias("record"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = MIN_BYTES,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the deduplicated archives of ``pages`` below ``path``."""
    (records(pages, date, min_bytes).write.mode("overwrite").option("lineSep", _CRLF * 2)
     .option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def _parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of one archive: headers (lower-case names) and content block."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        begin = stop + 4
        end = begin + int(head["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end after Content-Length")
        yield head, data[begin:end]
        at = end + 4


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()),
           ("refers_to_record", pa.string()), ("header_digest", pa.string()), ("payload_bytes", pa.int64()),
           ("payload_digest", pa.string()), ("payload", pa.binary())]


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Parse the archives below ``path``: a row per record.

    ``payload_bytes``, ``payload_digest`` (bare hex SHA-256) and ``payload``
    are taken from the stored payload and null for revisits;
    ``header_digest`` is what the header says.
    """
    fields = _FIELDS if with_payload else _FIELDS[:-1]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[] for _ in fields]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(cols, fields)], schema=schema)

        for b in batches:
            for k in range(b.num_rows):
                data = b.column(0)[k].as_py()
                rows = []
                for head, block in _parsed(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    body = block.partition(b"\r\n\r\n")[2] if head["warc-type"] == "response" else None
                    page = head.get("warc-page-id")
                    row = (int(page) if page else None, head.get("warc-target-uri"), head["warc-type"],
                           head["warc-record-id"], head.get("warc-refers-to"),
                           head["warc-payload-digest"].removeprefix("sha256:"),
                           None if body is None else len(body),
                           None if body is None else hashlib.sha256(body).hexdigest(), body)
                    rows.append(row[:len(fields)])
                    if len(rows) == 512:
                        yield out(rows)
                        rows = []
                yield out(rows)

    kinds = ("page_id bigint, url string, record_type string, record_id string, refers_to_record string, "
             "header_digest string, payload_bytes bigint, payload_digest string")
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, kinds + (", payload binary" if with_payload else ""))


def resolve(rows: DataFrame) -> DataFrame:
    """Join revisits to their originals: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Originals are distinct by record id, so a revisit meets one row and
    nothing multiplies; a revisit whose original is missing has null
    payload columns.
    """
    heads = stage(rows.select("page_id", "record_type", "record_id", "refers_to_record", "payload_bytes",
                              "payload_digest"), "warc-heads")
    refs = heads.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("record_id")).distinct()
    originals = stage(heads.where("record_type = 'response'").join(
        refs, "record_id", "left_semi").groupBy("record_id").agg(
            F.first("page_id").alias("o_page"), F.first("payload_bytes").alias("o_bytes"),
            F.first("payload_digest").alias("o_digest")), "warc-originals")
    j = heads.join(originals.withColumnRenamed("record_id", "o_id"), F.col("refers_to_record") == F.col("o_id"), "left")
    return j.select("page_id", F.coalesce("payload_bytes", "o_bytes").alias("payload_bytes"),
                    F.coalesce("payload_digest", "o_digest").alias("payload_digest"), "record_type",
                    F.col("o_page").alias("refers_to"))
