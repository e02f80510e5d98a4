"""WARC archives of web pages: write transactions, read them back, assemble one nested row per capture.

Every page becomes a transaction of three records: request, response (or revisit) and metadata. Requests and metadata
name the record they belong to in WARC-Concurrent-To; revisits name the record with the payload in WARC-Refers-To.
Spark's text writer lays the records out with the record terminator as line separator; archives are read as bytes and
parsed by Content-Length, so payloads may hold anything, record headers included. Payloads and HTTP headers are read back
with their records: size and digest are taken from the payload that was read, a capture holds its response with payload
and headers, and a revisit is resolved to the payload of the record it refers to. A query that needs no payload drops the
column from the table of records before it assembles captures, so that none is shuffled.

Defined cases: a null page has an empty payload; a null address leaves out WARC-Target-URI; line breaks in an address
are percent-encoded; pages under `min_revisit` bytes are always responses; of equal payloads the largest page_id is the
response, and rows that repeat that page_id are responses too; a null page_id revisits any numbered page; repeated rows
stay one capture each; an empty table gives no archive and no rows. Columns other than page_id, url, html are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, stored

MIN_REVISIT = 1000
# Uncompressed bytes that an archive holds on average; a reader task streams one archive at a time.
ARCHIVE_BYTES = 32 << 20
CAPTURED = "2024-01-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "kind string, record_id string, concurrent_to string, refers_to string, target_uri string, block_bytes long,"
    " payload_bytes long, payload_digest string, fields map<string,string>, first_line string, http map<string,string>,"
    " payload binary"
)
# Payload bytes that a reader hands on at once.
HANDED_BYTES = 16 << 20


def _record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column, headers: list[tuple[str, Column | None]], block: Column) -> Column:
    """One record without its terminator; a header whose value is null is left out."""
    lines = [F.lit(f"WARC/1.1{END}WARC-Type: "), kind, F.lit(END)]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit("")))
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END), block]
    return F.concat(*lines)


def _planned(pages: DataFrame, min_revisit: int) -> DataFrame:
    """Pages with payload measures and `keeper`, the page_id that holds an equal payload (null: the page itself)."""
    measured = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha1(F.encode("html", "UTF-8")).alias("digest")
    )
    # map-side counts; stored, so that a hot payload meets the join below as an ordinary skewed exchange
    keepers = stored(
        measured.where(F.col("payload_bytes") >= min_revisit)
        .groupBy(F.col("digest").alias("kept_digest"))
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "keepers",
    )
    joined = measured.join(
        keepers, (F.col("digest") == F.col("kept_digest")) & (F.col("payload_bytes") >= min_revisit), "left"
    ).drop("kept_digest")
    revisits = F.col("keeper").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper")))
    return joined.withColumn("keeper", F.when(revisits, F.col("keeper")))


def transactions(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """One column `value`: the three records of a page."""
    p = _planned(pages, min_revisit)
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    main_id = _record_id(F.lit("response"), F.col("page_id"), F.col("digest"))
    revisit = F.col("keeper").isNotNull()
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END + END),
    )
    date = ("WARC-Date", F.lit(CAPTURED))
    request = _record(
        F.lit("request"),
        [
            ("WARC-Record-ID", _record_id(F.lit("request"), F.col("page_id"), F.col("digest"), uri)),
            ("WARC-Concurrent-To", main_id),
            ("WARC-Target-URI", uri),
            date,
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{END}{END}")),
    )
    main = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        [
            ("WARC-Record-ID", main_id),
            ("WARC-Target-URI", uri),
            date,
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("WARC-Refers-To", F.when(revisit, _record_id(F.lit("response"), F.col("keeper"), F.col("digest")))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("html"))),
    )
    metadata = _record(
        F.lit("metadata"),
        [
            ("WARC-Record-ID", _record_id(F.lit("metadata"), F.col("page_id"), F.col("digest"), uri)),
            ("WARC-Concurrent-To", main_id),
            ("WARC-Target-URI", uri),
            date,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(
            F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(END)), F.lit("")),
            F.concat(F.lit("payload-bytes: "), F.col("payload_bytes").cast("string"), F.lit(END)),
        ),
    )
    return p.select(F.concat_ws(END + END, request, main, metadata).alias("value"))


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES):
    """Write gzipped archives of about `archive_bytes` each."""
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    per_file = max(1, int(archive_bytes / (mean + 1024)))
    writer = transactions(pages, min_revisit).write.option("lineSep", END + END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", per_file).text(path)


def _fields(lines) -> dict[str, str]:
    pairs = (line.decode("utf-8").split(":", 1) for line in lines)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _header(stream) -> dict[str, str]:
    lines = []
    while (line := stream.readline()) not in (b"\r\n", b""):
        lines.append(line)
    return _fields(lines)


def _http(block: bytes):
    """(first line, headers, payload) of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    return first.decode("utf-8"), _fields(lines), payload


def records(content: bytes):
    """Records of one gzipped archive, streamed: only one block is held at a time."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record where one was due: {version[:40]!r}")
        h = _header(stream)
        n = int(h["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("archive ends inside a record")
        kind, size, digest, fields, first, http, payload = h["warc-type"], None, None, {}, None, {}, None
        if h.get("content-type", "").startswith("application/http"):
            first, http, payload = _http(block)
        if kind == "response":
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
            if h["warc-payload-digest"] != f"sha1:{digest}":
                raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
        elif kind == "revisit":
            digest = h["warc-payload-digest"].removeprefix("sha1:")
        elif kind == "metadata":
            fields = _fields(block.splitlines())
        yield (
            kind,
            h["warc-record-id"],
            h.get("warc-concurrent-to"),
            h.get("warc-refers-to"),
            h.get("warc-target-uri"),
            n,
            size,
            digest,
            fields,
            first,
            http,
            payload if kind == "response" else None,
        )


def _parsed(batches):
    names = [c.strip().split(" ")[0] for c in RECORD.replace("<string,string>", "").split(",")]

    def handed(rows):
        return pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64", "block_bytes": "Int64"})

    for batch in batches:
        for content in batch["content"]:
            rows, size = [], 0
            for row in records(content):
                rows.append(row)
                size += 1024 + row[5]
                if size >= HANDED_BYTES:
                    yield handed(rows)
                    rows, size = [], 0
            if rows:
                yield handed(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(_parsed, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: kind, record_id, refers_to, refers_to_page and nested request, response, metadata.

    Requests and metadata are matched to their record through WARC-Concurrent-To and the address. A transaction lacking
    one of them keeps a null there. Only revisits are joined to the record they refer to. Records without their `payload`
    column give captures without it.
    """
    main = found.where(F.col("kind").isin("response", "revisit")).drop("concurrent_to", "fields")
    side = {}
    for kind, columns in (("request", ["block_bytes", "first_line", "http"]), ("metadata", ["block_bytes", "fields"])):
        one = found.where(F.col("kind") == kind).dropDuplicates(["record_id"])
        side[kind] = one.select(
            F.col("concurrent_to").alias(f"{kind}_of"),
            F.col("target_uri").alias(f"{kind}_uri"),
            *[F.col(c).alias(f"{kind}_{c}") for c in ("record_id", *columns)],
        )

    def with_side(rows: DataFrame, kind: str) -> DataFrame:
        on = (F.col("record_id") == F.col(f"{kind}_of")) & F.col("target_uri").eqNullSafe(F.col(f"{kind}_uri"))
        return rows.join(side[kind], on, "left").drop(f"{kind}_of")

    holders = stored(
        with_side(main.where("kind = 'response'").select("record_id", "target_uri"), "metadata")
        .select(F.col("record_id").alias("held_by"), F.col("metadata_fields")["page-id"].cast("long").alias("refers_to_page"))
        .dropDuplicates(["held_by"]),
        "holders",
    )
    revisits = main.where("refers_to IS NOT NULL").join(holders, F.col("refers_to") == F.col("held_by"), "left")
    rest = main.where("refers_to IS NULL").withColumn("refers_to_page", F.lit(None).cast("long"))
    whole = with_side(with_side(revisits.drop("held_by").unionByName(rest), "request"), "metadata")

    def nested(kind: str, *columns: str) -> Column:
        own = [F.col(f"{kind}_{c}").alias(c) for c in ("record_id", "target_uri", *columns)]
        return F.when(F.col(f"{kind}_record_id").isNotNull(), F.struct(*own)).alias(kind)

    whole = whole.withColumnsRenamed({"request_uri": "request_target_uri", "metadata_uri": "metadata_target_uri"})
    response = ["record_id", "target_uri", "block_bytes", "payload_bytes", "payload_digest", "first_line", "http", "payload"]
    return whole.select(
        "kind",
        "record_id",
        "refers_to",
        "refers_to_page",
        nested("request", "block_bytes", "first_line", "http"),
        F.struct(*[c for c in response if c in whole.columns]).alias("response"),
        nested("metadata", "block_bytes", "fields"),
    )


def resolved(captures: DataFrame) -> DataFrame:
    """page_id, url, html of every capture; a revisit has the payload of the record that it refers to."""
    url = F.regexp_replace(F.regexp_replace("response.target_uri", "%0D", "\r"), "%0A", "\n")
    page = captures.select(
        F.col("metadata.fields")["page-id"].cast("long").alias("page_id"), url.alias("url"), "refers_to", "response.payload"
    )
    held = captures.where("kind = 'response'").select(F.col("record_id").alias("held_by"), F.col("response.payload").alias("held"))
    revisits = page.where("refers_to IS NOT NULL").join(
        held.dropDuplicates(["held_by"]), F.col("refers_to") == F.col("held_by"), "left"
    )
    both = page.where("refers_to IS NULL").select("page_id", "url", "payload").unionAll(
        revisits.select("page_id", "url", F.col("held").alias("payload"))
    )
    return both.select("page_id", "url", F.decode("payload", "UTF-8").alias("html"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and return the capture of each page."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    found = stored(read_records(spark, path), "records")
    c = assemble(found.drop("payload"))
    meta = F.col("metadata.fields")
    return c.select(
        meta["page-id"].cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", meta["payload-bytes"].cast("long")).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM k
"""
