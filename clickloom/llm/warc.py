"""WARC archives: written by Spark, gzipped, read back along verified record boundaries.

A page's record is ASCII headers and UTF-8 text, so Spark's text writer makes the archives: one line per
record, with the two line ends that close a record as line separator. Pages with equal payloads
are stored once; the others become revisit records without a payload.

A payload may hold the magic that opens a record. So tasks that read archives emit every place
where a record could begin, with the place its own length says the next one begins. Pointer jumping
over these links, from the start of each file, keeps the candidates that the chain of real
records reaches and rejects the others; the number of joins is the logarithm of the records in a file.

Defined cases: a null or empty html is an empty payload; a null url is an empty one; a null
page_id is written as an empty name, read back as null and never the target of a revisit while another page has
the same payload; rows with the same page_id and payload are each stored, all as responses if theirs is
the smallest id; a page of any length is one record; other columns are never looked at; an empty
table gives archives without records and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import scratch_dir

#: Fixed values of the format.
MAGIC, END, GZIP = "WARC/1.1\r\n", "\r\n\r\n", b"\x1f\x8b"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Records in an archive at most: a task holds one whole file, unpacked. Offsets are those in the unpacked file.
RECORDS_PER_FILE = 1000

_CANDIDATE = ("file bigint, at bigint, next bigint, page_id bigint, record_type string, payload_bytes bigint, "
              "payload_digest string, refers_to bigint")


def base32_sha1(data: Column) -> Column:
    """The bare upper-case base32 SHA-1, forty bits at a time."""
    digest = F.sha1(data)
    part = lambda k: F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(k) for k in range(4)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, revisit_from_bytes: int = 0) -> DataFrame:
    """One column, ``record``: each page's record without the line ends that close it."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    size = F.octet_length("html")
    first = rows.filter(size >= revisit_from_bytes).groupBy("digest").agg(F.min("page_id").alias("of"))
    rows = rows.join(first, "digest", "left")
    same = F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("of"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
                    size.cast("string"), F.lit(END))
    block = F.when(same, http).otherwise(F.concat(http, F.col("html")))
    field = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(same, "revisit").otherwise("response")),
        field("WARC-Record-ID", name("page_id")),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\x00-\x20]", "")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(same, F.concat(field("WARC-Refers-To", name("of")), field("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, revisit_from_bytes: int = 0,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    (records(pages, revisit_from_bytes).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


_HEADER = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")
_NAME = re.compile(rb"<urn:page:(-?\d+)>")


def candidates_in(data: bytes) -> Iterator[dict]:
    """Every place where the bytes could hold a record, with what it would say."""
    magic, at = MAGIC.encode(), -1
    while (at := data.find(magic, at + 1)) >= 0:
        stop = data.find(END.encode(), at)
        if stop < 0:
            return
        head = dict(_HEADER.findall(data[at + len(magic):stop + 2]))
        length = head.get(b"Content-Length", b"")
        begin = stop + len(END)
        if not length.isdigit() or begin + int(length) + len(END) > len(data):
            continue
        end = begin + int(length)
        if data[end:end + len(END)] != END.encode():
            continue
        block = data.find(END.encode(), begin, end)
        http = dict(_HEADER.findall(data[begin:block + 2])) if block >= 0 else {}
        kind = head.get(b"WARC-Type", b"").decode("ascii", "replace")
        named = lambda key: int(m[1]) if (m := _NAME.fullmatch(head.get(key, b""))) else None
        row = {"at": at, "next": end + len(END), "page_id": named(b"WARC-Record-ID"), "record_type": kind,
               "refers_to": named(b"WARC-Refers-To")}
        if kind == "revisit":
            said = http.get(b"Content-Length", b"")
            row["payload_bytes"] = int(said) if said.isdigit() else None
            row["payload_digest"] = head.get(b"WARC-Payload-Digest", b"").decode("ascii", "replace").removeprefix("sha1:")
        else:
            payload = data[block + len(END):end] if block >= 0 else b""
            row["payload_bytes"] = len(payload)
            row["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        yield row


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """What could be a record in each archive of a folder, real or not."""
    names = ["file", "at", "next", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file = batch["file"][i].as_py()
                data = batch["content"][i].as_py()
                data = gzip.decompress(data) if data[:2] == GZIP else data
                rows = [{"file": file, **row} for row in candidates_in(data)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[n] for row in rows], t) for n, t in zip(names, kinds)], names)

    files = spark.read.format("binaryFile").load(path)
    return files.select(F.xxhash64("path").alias("file"), "content").mapInArrow(run, _CANDIDATE)


def reachable(links: DataFrame) -> DataFrame:
    """Of links (file, at, next), the (file, at) that the chain from offset 0 of their file reaches."""
    spark = links.sparkSession

    def stored(frame: DataFrame) -> DataFrame:
        place = scratch_dir(spark, "jumps")
        frame.write.parquet(place)
        return spark.read.parquet(place)

    state = links.select("file", "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("reached"))
    while True:
        hit = state.filter("reached AND jump IS NOT NULL").select("file", F.col("jump").alias("at"), F.lit(True).alias("hit"))
        further = state.select("file", F.col("at").alias("jump"), F.col("jump").alias("beyond"))
        grown = (state.join(further, ["file", "jump"], "left").join(hit, ["file", "at"], "left")
                 .select("file", "at", F.col("beyond").alias("jump"),
                         (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached")))
        state = stored(grown)
        # a real record's jump is null once the end of the file is nearer than its length
        if not state.filter("reached AND jump IS NOT NULL").limit(1).count():
            return state.filter("reached").select("file", "at")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The real records of all archives in a folder."""
    place = scratch_dir(spark, "candidates")
    candidates(spark, path).write.parquet(place)
    found = spark.read.parquet(place)
    return found.join(reachable(found), ["file", "at"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_dir(spark, "archives")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), place)
    return read_archives(spark, place)


OP3_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS of,
    list_aggregate([
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + CAST(('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT // (32 ** (7 - i % 8))::BIGINT % 32 AS INTEGER), 1)
      FOR i IN range(32)], 'string_agg', '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = of THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> of THEN of END AS refers_to
FROM d
"""
