"""WARC archives: captures written as records, read back, and put together again.

``write`` makes three records of a page: the request, the response (or, for a
payload that another page already has, a revisit), and metadata.  Request and
metadata name the response in ``WARC-Concurrent-To``.  Records are built as
expressions and written by Spark's text writer with an empty line as the end
of a record, in gzip files; so a lost task is written again, and what is read
is what committed tasks wrote, in any store that Spark reaches.

``records`` reads such files, or any gzip archives: lines are put together by
``Content-Length``, so nothing inside a payload can look like a record.  A task
holds one record at a time.  ``captures`` assembles the transactions: records
that name each other as concurrent, in either direction or through one record
between them, become one nested row.

A payload of ``LEAST`` bytes or more is stored once: by the page with the least
id (then URL); the others are revisits that refer to it.  Keys with a large
share of the rows (one payload of most pages, one response that most metadata
name) are joined apart: there are at most ``common.SHARE`` of them.

Defined results: a null html is an empty payload; a null URL is read back null
(its target is ``urn:page``); a null id is the largest; rows that repeat id,
URL and html are captures of their own, copies after the first of a page being
revisits of the first; an empty table gives an archive without records; a
record without a response is a capture without one; other columns are ignored.
A file that ends inside a record fails, and so does one that Spark has split,
which can be but an uncompressed one beyond spark.sql.files.maxPartitionBytes.
"""

from __future__ import annotations

import datetime
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common

LEAST = 100
#: Records a file, at most.
RECORDS = 60_000
#: Requests, metadata and others that one nested row is meant to hold; a capture with more has further rows.
NESTED = 1000
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY = ("response", "revisit", "resource")
RECORD = ("record_id string, type string, target_uri string, date string, content_type string, concurrent_to array<string>, refers_to string, "
          "declared_digest string, head binary, payload binary, payload_bytes long, payload_digest string")


def urn(*parts: Column) -> Column:
    """A record's name, from what tells it apart."""
    d = F.sha2(F.concat_ws("|", *parts), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(d, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def one_line(value: Column) -> Column:
    return F.replace(F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(" "), F.lit("%20"))


def record(headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.concat(F.lit(f"{END}{name}: "), value) for name, value in headers]
    return F.concat(F.lit("WARC/1.1"), *lines, F.lit(f"{END}Content-Length: "), F.octet_length(block).cast("string"), F.lit(END * 2), block)


def roles(pages: DataFrame) -> DataFrame:
    """(key, page_id, url, digest, bytes, copies, first): the distinct rows of
    ``pages`` and, where others have the same payload, the one that stores it."""
    each = pages.groupBy("key").agg(*[F.first(c).alias(c) for c in ("page_id", "url", "digest", "bytes")], F.count("*").alias("copies"))
    each = common.stored(each, "warc-pages")
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "key")
    shared = each.where(F.col("bytes") >= LEAST).groupBy("digest").agg(F.min(order).alias("first"), F.sum("copies").alias("n")).where("n > 1").select("digest", "first")
    return common.stored(common.looked_up(each, "digest", shared), "warc-roles")


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str | None = None) -> None:
    """The captures of ``pages`` as gzip WARC files in ``folder``."""
    date = F.lit(date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))
    named = [F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(c).cast("string"))) for c in ("page_id", "url")]
    rows = rows.withColumn("key", F.sha2(F.concat_ws("\n", F.col("digest"), *named), 256))
    who = roles(rows.drop("payload"))
    stores = F.col("first").isNull() | (F.col("first.key") == F.col("key"))
    # Equal rows meet before their payload does more than one shuffle.
    bodies = rows.groupBy("key").agg(F.first("payload").alias("payload"))
    whole = who.where(stores).join(bodies, "key").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.when(F.col("first").isNull(), F.col("copies")).otherwise(1))))
    again = who.where("first is not null").where(~stores | (F.col("copies") > 1)).withColumn("payload", F.lit(None).cast("string")) \
        .withColumn("copy", F.explode(F.sequence(F.when(stores, 2).otherwise(1).cast("long"), F.col("copies"))))
    columns = ["key", "copy", "page_id", "url", "digest", "bytes", "first", "payload"]
    rows = whole.select(columns).unionByName(again.select(columns))

    copy = F.col("copy").cast("string")
    me = urn(F.col("key"), copy, F.lit("response"))
    target = F.coalesce(one_line(F.col("url")), F.lit("urn:page"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END * 2))
    common_part = [("WARC-Date", date), ("WARC-Target-URI", target)]
    aside = [*common_part, ("WARC-Concurrent-To", me)]
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    answer = ("Content-Type", F.lit("application/http; msgtype=response"))
    request = record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", urn(F.col("key"), copy, F.lit("request"))), *aside, ("Content-Type", F.lit("application/http; msgtype=request"))],
                     F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{END * 2}")))
    response = record([("WARC-Type", F.lit("response")), ("WARC-Record-ID", me), *common_part, digest, answer], F.concat(http, "payload"))
    revisit = record([("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", me), *common_part, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", urn(F.col("first.key"), F.lit("1"), F.lit("response"))),
                      ("WARC-Refers-To-Target-URI", F.coalesce(one_line(F.col("first.url")), F.lit("urn:page"))), ("WARC-Refers-To-Date", date), digest, answer], http)
    about = F.concat(F.lit("page: "), F.to_json(F.struct("page_id", "url")), F.lit(END))
    metadata = record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", urn(F.col("key"), copy, F.lit("metadata"))), *aside, ("Content-Type", F.lit("application/warc-fields"))], about)
    value = F.explode(F.array(request, F.when(F.col("payload").isNull(), revisit).otherwise(response), metadata))
    rows.select(value.alias("value")).write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(folder)


class Cutter:
    """Cuts the lines of one file into records, by their stated lengths."""

    def __init__(self):
        self.headers: list[bytes] = []
        self.block: list[bytes] = []
        self.need = -1  # bytes that the block lacks; -1 outside of blocks

    def feed(self, line: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
        """The record that ends in the line, if one does."""
        if self.need >= 0:
            part = line[:self.need]
            self.block.append(part)
            self.need -= len(part)
            line = line[len(part):]
            if self.need:
                return
            yield self.done()
        if not line.strip():
            if self.headers:
                self.need = int(dict(self.fields())["content-length"])
                if not self.need:
                    yield self.done()
        elif line[:1] in b" \t" and self.headers:
            self.headers[-1] += b" " + line.strip()
        else:
            self.headers.append(line.strip())

    def fields(self) -> list[tuple[str, str]]:
        if not self.headers[0].startswith(b"WARC/"):
            raise ValueError(f"no record begins with {self.headers[0][:40]!r}")
        pairs = (h.decode("utf-8", "replace").partition(":") for h in self.headers[1:])
        return [(name.strip().lower(), value.strip()) for name, _, value in pairs]

    def done(self) -> tuple[list[tuple[str, str]], bytes]:
        out = self.fields(), b"".join(self.block)
        self.headers, self.block, self.need = [], [], -1
        return out

    def close(self) -> None:
        if self.headers:
            raise ValueError("an archive ends inside a record")


def row(fields: list[tuple[str, str]], block: bytes, payloads: bool) -> tuple:
    """The columns of ``RECORD``; the payload is what follows the HTTP header."""
    of = dict(reversed(fields))  # the first of a name
    head, payload = b"", block
    if of.get("content-type", "").startswith("application/http"):
        head, end, payload = block.partition(b"\r\n\r\n")
        head += end
    kind, digest = of.get("warc-type"), of.get("warc-payload-digest")
    return (of.get("warc-record-id"), kind, of.get("warc-target-uri"), of.get("warc-date"), of.get("content-type"), [v for k, v in fields if k == "warc-concurrent-to"], of.get("warc-refers-to"),
            digest and digest.rpartition(":")[2], head, payload if payloads or kind not in PRIMARY else None, len(payload), hashlib.sha256(payload).hexdigest())


def records(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives in ``folder``, with the columns of ``RECORD``;
    the payloads of responses only where they are wanted, length and digest always."""
    lines = spark.read.option("lineSep", "\n").text(folder).select(F.col("value").cast("binary").alias("line"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    names = [f.split()[0] for f in RECORD.split(", ")]
    types = [pa.list_(pa.string()) if n == "concurrent_to" else pa.binary() if n in ("head", "payload") else pa.int64() if n == "payload_bytes" else pa.string() for n in names]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, now, found, size = Cutter(), None, [], 0
        for b in batches:
            for line, file, start in zip(b.column("line").to_pylist(), b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                if file != now:
                    if start:
                        raise ValueError("an archive was split; compress it or raise spark.sql.files.maxPartitionBytes")
                    cutter.close()
                    now = file
                for fields, block in cutter.feed(line + b"\n"):
                    found.append(row(fields, block, payloads))
                    size += len(block)
                if len(found) >= 1000 or size > 1 << 22:
                    yield batch(found)
                    found, size = [], 0
        cutter.close()
        if found:
            yield batch(found)

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

    return common.map_arrow(lines, RECORD, run)


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, part, response (a struct; a revisit
    or resource too), and arrays of the other records: requests, metadata, others.

    ``found``: records as a stored table.  Beyond about ``NESTED`` records
    beside the response a capture has further parts, without the response; a
    record that leads to several responses goes with the least name."""
    primary = F.coalesce(F.col("type").isin(*PRIMARY), F.lit(False))
    named = found.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b")).where("a <> b")
    links = common.stored(named.union(named.select("b", "a")).distinct(), "warc-links")
    mains = found.where(primary).select(F.col("record_id").alias("b"), F.col("record_id").alias("capture")).distinct()
    near = common.looked_up(links, "b", mains).where("capture is not null").groupBy(F.col("a").alias("b")).agg(F.min("capture").alias("capture"))
    near = common.stored(near, "warc-near")
    far = common.looked_up(links, "b", near).where("capture is not null").select("a", "capture", F.lit(1).alias("way"))
    member = near.select(F.col("b").alias("a"), "capture", F.lit(0).alias("way")).union(far).groupBy(F.col("a").alias("record_id")).agg(F.min(F.struct("way", "capture"))["capture"].alias("capture_id"))
    beside = found.where(~primary).join(member, "record_id", "left").withColumn("capture_id", F.coalesce("capture_id", "record_id"))
    beside = common.stored(beside, "warc-beside")
    counted = common.looked_up(beside, "capture_id", beside.groupBy("capture_id").agg(F.count("*").alias("n")))
    part = F.when(F.col("n") > NESTED, F.pmod(F.xxhash64("record_id"), F.ceil(F.col("n") / NESTED))).otherwise(F.lit(0)).cast("long")
    whole = F.struct(*found.columns)
    pick = lambda which: F.array_sort(F.collect_list(F.when(which, whole)))
    request, metadata = F.col("type") == "request", F.col("type") == "metadata"
    nested = counted.withColumn("part", part).groupBy("capture_id", "part").agg(
        pick(request).alias("requests"), pick(metadata).alias("metadata"), pick(~F.coalesce(request | metadata, F.lit(False))).alias("others"))
    mains = found.where(primary).select(F.col("record_id").alias("capture_id"), F.lit(0).cast("long").alias("part"), whole.alias("response"))
    return mains.join(nested, ["capture_id", "part"], "full").select("capture_id", "part", "response", *[F.coalesce(c, F.array()).alias(c) for c in ("requests", "metadata", "others")])


def of_pages(done: DataFrame) -> DataFrame:
    """(capture_id, page_id, url, record_type, payload_bytes, payload_digest,
    refers_to) of the pages that ``write`` has written; a revisit's payload is
    that of the response it refers to."""
    about = F.from_json(F.regexp_extract(F.col("metadata")[0]["payload"].cast("string"), r"page: ([^\r\n]*)", 1), "page_id long, url string")
    each = done.where("response is not null").select("capture_id", about.alias("about"), F.col("response.type").alias("record_type"), "response.payload_bytes", "response.payload_digest", "response.refers_to")
    each = common.stored(each.select("capture_id", "about.page_id", "about.url", "record_type", "payload_bytes", "payload_digest", "refers_to"), "warc-captures")
    whole = each.where("record_type = 'response'").select(F.col("capture_id").alias("refers_to"), F.struct("page_id", "payload_bytes", "payload_digest").alias("of"))
    again = common.looked_up(each.where("record_type = 'revisit'"), "refers_to", whole)
    first = each.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return first.unionByName(again.select("capture_id", "page_id", "url", "record_type", "of.payload_bytes", "of.payload_digest", F.col("of.page_id").alias("refers_to")))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op12: the pages as they come back from the archives."""
    folder = f"{common.shared_folder(spark)}/llm-warc-{uuid.uuid4().hex}"
    write(common.table(spark, sf_dir, "pages"), folder)
    found = common.stored(records(spark, folder, payloads=False), "warc-records")
    return of_pages(captures(found)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
    r AS (SELECT *, CASE WHEN payload_bytes >= {LEAST} THEN row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) ELSE 1 END AS nth,
                 min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN least END AS refers_to FROM r
"""
