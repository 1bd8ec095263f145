"""WARC files and transaction assembly (operator 7).

Writing: every capture becomes a request, a response (or revisit) and a
metadata record, tied by WARC-Concurrent-To.  Of captures with equal payloads
of at least ``min_revisit`` bytes the one with the smallest id is the
response, the others revisit it.

Records are written by Spark's text writer, one row a record and the record's
closing blank lines as the separator, gzip-compressed, into the shared folder;
the number of files follows the bytes, so that reading one file back takes
bounded memory.

Reading: files are parsed by Content-Length, requests and metadata are joined
to their response or revisit by WARC-Concurrent-To, revisits to the response
they refer to; one nested row per capture.

Defined results: null payload is empty; rows with equal id and payload are
captures of their own: the first is the response, the others revisit it; a null
id is an id of its own, ordered last; null url is empty; a very long
payload is one record and one cell; an empty table writes no record and reads
back empty; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored
from meterlake.session import scratch_path

CRLF = "\r\n"
MIN_REVISIT = 100
FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def holders(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, digest, holder of every page whose payload another row has
    too: ``holder`` is the smallest id with that payload.

    Only ids and digests are moved, and a payload that a third of all pages
    share costs one row a task before the shuffle.  The result is keyed by
    (page_id, digest), so joining it back meets no hot key."""
    light = stored(pages.select("page_id", F.sha2("payload", 256).alias("digest"),
                                F.octet_length("payload").cast("long").alias("bytes"))
                   .where(F.col("bytes") >= min_revisit), "page-digests")
    order = F.struct(F.col("page_id").isNull().alias("z"), F.col("page_id").alias("id"))
    shared = stored(light.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("digest", F.col("first.id").alias("holder")), "shared")
    return light.join(shared, "digest").select("page_id", "digest", "holder").distinct()


def header(fields: list[tuple[str, Column]], body: Column) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in fields]
    return F.concat(F.lit("WARC/1.1" + CRLF), *lines, F.lit("Content-Length: "),
                    F.octet_length(body).cast("string"), F.lit(CRLF + CRLF), body)


def one_line(text: Column) -> Column:
    """Header values stay on one line: line ends and '%' are percent-coded."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def plain_line(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_id(kind: str, page_id: Column, digest: Column, copy: Column) -> Column:
    return F.concat(F.lit(f"<urn:capture:{kind}:"), F.coalesce(page_id.cast("string"), F.lit("null")),
                    F.lit(":"), digest, F.lit(":"), copy.cast("string"), F.lit(">"))


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """One row per WARC record, column ``record``, of pages (page_id, url,
    payload string)."""
    # One text key for id and digest, never null: the join and the window below
    # then share one shuffle of the payloads.
    key = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.col("digest"))
    rows = pages.withColumn("digest", F.sha2("payload", 256)).withColumn("key", key)
    held = holders(pages, min_revisit).select(key.alias("key"), "holder", F.lit(True).alias("shared"))
    rows = rows.join(held, "key", "left")
    copy = F.row_number().over(Window.partitionBy("key").orderBy("url"))
    rows = rows.withColumn("copy", copy)
    pid, digest, first = F.col("page_id"), F.col("digest"), F.lit(1)
    holds = pid.eqNullSafe(F.col("holder")) & (F.col("copy") == 1)
    revisit = F.coalesce("shared", F.lit(False)) & ~holds
    main_id = F.when(revisit, record_id("revisit", pid, digest, F.col("copy"))).otherwise(
        record_id("response", pid, digest, F.col("copy")))
    url = one_line(F.col("url"))
    common = [("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", url)]
    said = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest))
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    head = F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + CRLF)
    response = header([("WARC-Type", F.lit("response")), ("WARC-Record-ID", main_id), *common, said, http],
                      F.concat(head, F.col("payload")))
    again = header([("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", main_id), *common, said,
                    ("WARC-Refers-To", record_id("response", F.col("holder"), digest, first)),
                    ("WARC-Profile", F.lit(REVISIT_PROFILE)), http], head)
    request = header([("WARC-Type", F.lit("request")),
                      ("WARC-Record-ID", record_id("request", pid, digest, F.col("copy"))), *common,
                      ("WARC-Concurrent-To", main_id),
                      ("Content-Type", F.lit("application/http; msgtype=request"))],
                     F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1" + CRLF + CRLF)))
    about = header([("WARC-Type", F.lit("metadata")),
                    ("WARC-Record-ID", record_id("metadata", pid, digest, F.col("copy"))), *common,
                    ("WARC-Concurrent-To", main_id), ("Content-Type", F.lit("application/warc-fields"))],
                   F.concat(F.lit("page-id: "), F.coalesce(pid.cast("string"), F.lit("null")), F.lit(CRLF)))
    return rows.select(F.explode(F.array(
        request, F.when(revisit, again).otherwise(response), about)).alias("record"))


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Write pages (page_id, url, payload; null payload: empty) as gzipped WARC
    files of about ``FILE_BYTES`` of payload each."""
    rows = pages.select("page_id", "url", F.coalesce("payload", F.lit("")).alias("payload"))
    size = rows.agg(F.avg(F.octet_length("payload") + 1500)).first()[0] or FILE_BYTES
    (records(rows, min_revisit).write
     .option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", max(3, int(3 * FILE_BYTES / size))).text(path))


RECORD_FIELDS = [("type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()),
                 ("refers_to", pa.string()), ("uri", pa.string()), ("date", pa.string()),
                 ("said_digest", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                 ("payload_sha256", pa.string())]
RECORD_TYPE = ("type string, record_id string, concurrent_to string, refers_to string, uri string, "
               "date string, said_digest string, payload binary, payload_bytes long, payload_sha256 string")


def parse(stream) -> Iterator[dict]:
    """Records of one open archive, by Content-Length; the payload of an http
    block is what follows its header."""
    import hashlib

    while line := stream.readline():
        if not line.strip():
            continue
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        payload = block
        if fields.get("content-type", "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        yield {"type": fields["warc-type"], "record_id": fields["warc-record-id"],
               "concurrent_to": fields.get("warc-concurrent-to"), "refers_to": fields.get("warc-refers-to"),
               "uri": plain_line(fields.get("warc-target-uri", "")), "date": fields.get("warc-date"),
               "said_digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
               "payload": payload, "payload_bytes": len(payload),
               "payload_sha256": hashlib.sha256(payload).hexdigest()}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``; a task holds one compressed
    file and a batch of records."""
    schema = pa.schema(RECORD_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip
        import io

        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for r in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    held.append(r)
                    size += r["payload_bytes"]
                    if size > 4 << 20 or len(held) >= 2000:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD_TYPE)


def assembled(records_: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, page_id, main (the response or
    revisit), requests, metadata.  Records meet on the id they are concurrent
    to; fields are gathered singly, so unused ones (payloads) never move."""
    main = F.col("type").isin("response", "revisit")
    key = F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to"))
    fields = [name for name, _ in RECORD_FIELDS if name != "concurrent_to"]

    def side(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct(
            "record_id", "uri", "date", F.col("payload").cast("string").alias("text")))))

    met = records_.groupBy(key.alias("capture_id")).agg(
        *[F.max(F.when(main, F.col(f))).alias(f"_{f}") for f in fields],
        side("request").alias("requests"), side("metadata").alias("metadata"))
    said = F.regexp_extract(F.get(F.col("metadata"), F.lit(0))["text"], r"page-id: (\d+|-\d+)", 1)
    return met.select("capture_id", F.when(said != "", said).cast("long").alias("page_id"),
                      F.struct(*[F.col(f"_{f}").alias(f) for f in fields]).alias("main"),
                      "requests", "metadata")


def resolved(captures: DataFrame) -> DataFrame:
    """page_id, record_type, payload_bytes, payload_digest, refers_to per
    capture; a revisit takes the size of the response it refers to."""
    light = stored(captures.select(
        "capture_id", "page_id", F.col("main.type").alias("type"), F.col("main.refers_to").alias("to"),
        F.col("main.payload_bytes").alias("bytes"), F.col("main.payload_sha256").alias("sha"),
        F.col("main.said_digest").alias("said")), "captures")
    held = light.where("type = 'response'").select(
        F.col("capture_id").alias("to"), F.col("page_id").alias("holder"), F.col("bytes").alias("held"))
    again = F.col("type") == "revisit"
    return light.join(held, "to", "left").select(
        "page_id", F.col("type").alias("record_type"),
        F.when(again, F.col("held")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(again, F.col("said")).otherwise(F.col("sha")).alias("payload_digest"),
        F.when(again, F.col("holder")).alias("refers_to"))


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             payload_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back,
    assembled."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages.select(col(pages, id_col).alias("page_id"), col(pages, url_col).alias("url"),
                                col(pages, payload_col).alias("payload")), path)
    return assembled(read_records(spark, path))
