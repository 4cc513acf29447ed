"""A content-addressed web archive: each payload stored once, every record's header kept.

The archive is two tables. ``payloads`` has one row per different payload under its SHA-256;
``records`` has the exact header bytes of every record and the address of its payload. A record
is its header, then (for responses) its payload; joining the tables gives the original bytes.
Digests are checked twice: when payloads merge, length and SHA-1 must agree with the SHA-256,
and on reading every payload must hash to its address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.workspace import work_path

# The RFC 4648 base-32 alphabet and the profile of revisit records.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of bytes in base 32: eight letters from each ten hexadecimal digits."""
    digest = F.sha1(payload)
    letters = []
    for group in range(4):
        value = F.conv(F.substring(digest, 10 * group + 1, 10), 16, 10).cast("long")
        letters += [
            F.substr(F.lit(BASE32), F.shiftright(value, 35 - 5 * i).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
            for i in range(8)
        ]
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _header(page: Column, url: Column, kind: Column, refers: Column, sha1: Column, size: Column) -> Column:
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"), F.lit("\r\n\r\n"),
    )
    body = F.octet_length(http) + F.when(kind == "response", size).otherwise(0)
    key = F.md5(F.concat_ws("\n", F.coalesce(page.cast("string"), F.lit("-")), F.coalesce(url, F.lit("-"))))
    record = F.regexp_replace(key, "(.{8})(.{4})(.{4})(.{4})(.{12})", "<urn:uuid:$1-$2-$3-$4-$5>")
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", record),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        _line("WARC-Profile", F.when(kind == "revisit", F.lit(REVISIT_PROFILE))),
        _line("X-Page-Id", page.cast("string")),
        _line("X-Refers-To-Page-Id", F.when(kind == "revisit", refers.cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", body.cast("string")), F.lit("\r\n"), http,
    ).cast("binary")


def write_archive(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = 0,
) -> None:
    """Write the payload and the record table of all pages.

    A NULL payload is empty. Of pages with equal payloads of at least ``least_bytes`` bytes the
    one with the smallest id is the response, all others revisit it; a page that repeats the
    smallest id, and pages of a payload that has no ids at all, are responses too. Other columns
    are not stored.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
        payload.alias("payload"), F.unhex(F.sha2(payload, 256)).alias("address"),
    )
    one = F.struct(F.octet_length("payload").cast("long").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1"))
    # Copies merge in each task first, so a page held by a third of the rows is sent once a task.
    merged = (
        rows.withColumn("is", one)
        .groupBy("address")
        .agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_page"),
             F.min("is").alias("is"), F.max("is").alias("last"))
    )
    same = F.when(F.col("is") == F.col("last"), F.col("is")).otherwise(
        F.raise_error(F.lit("two payloads have one SHA-256"))
    )
    (
        merged.withColumn("is", same)
        .select("address", "payload", "first_page", F.col("is.bytes").alias("bytes"), F.col("is.sha1").alias("sha1"))
        .write.mode("overwrite").parquet(f"{folder}/payloads")
    )
    known = spark.read.parquet(f"{folder}/payloads").drop("payload")
    joined = rows.drop("payload").join(known, "address")
    first = F.col("page_id").eqNullSafe(F.col("first_page")) | (F.col("bytes") < least_bytes)
    kind = F.when(first, "response").otherwise("revisit")
    (
        joined.withColumn("kind", kind)
        .select("address", _header(
            F.col("page_id"), F.col("url"), F.col("kind"), F.col("first_page"), F.col("sha1"), F.col("bytes")
        ).alias("header"))
        .write.mode("overwrite").parquet(f"{folder}/records")
    )


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads whose bytes hash to their address; anything else is an error."""
    table = spark.read.parquet(f"{folder}/payloads").select("address", "payload")
    checked = F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a payload does not match its address"))
    )
    return table.withColumn("payload", checked)


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The original records as bytes (``record``), each ended by the two line ends of the format."""
    records = spark.read.parquet(f"{folder}/records").withColumn("text", F.decode("header", "utf-8"))
    end = F.lit("\r\n\r\n").cast("binary")
    kind = _field(F.col("text"), "WARC-Type")
    revisits = records.where(kind == "revisit").select(F.concat("header", end).alias("record"))
    responses = records.where(kind == "response").join(_payloads(spark, folder), "address")
    return responses.select(F.concat("header", "payload", end).alias("record")).unionByName(revisits)


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` from an archive.

    Type and ids come from the stored headers, length and digest from the stored payload bytes.
    """
    stats = _payloads(spark, folder).select(
        "address", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    text = F.decode("header", "utf-8")
    records = spark.read.parquet(f"{folder}/records").select(
        "address", _field(text, "X-Page-Id").cast("long").alias("page_id"),
        _field(text, "WARC-Type").alias("record_type"),
        _field(text, "X-Refers-To-Page-Id").cast("long").alias("refers_to"),
        F.substring_index(_field(text, "WARC-Payload-Digest"), ":", -1).alias("stored"),
    )
    digest = F.when(F.col("stored") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a record's digest is not that of its payload"))
    )
    return records.join(stats, "address").select(
        "page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to"
    )


def archive_report(pages: DataFrame, **columns) -> DataFrame:
    """Archive all pages in the shared folder and report what is read back."""
    folder = work_path(pages.sparkSession, "warc")
    write_archive(pages, folder, **columns)
    return read_report(pages.sparkSession, folder)
