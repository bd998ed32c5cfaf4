"""A content-addressed WARC archive.

An archive is a folder of two tables:

* ``payloads``: every different payload once, under its address, the SHA-256
  of its bytes, with the record id and page of its response;
* ``headers``: the exact WARC and HTTP header bytes of every record, with the
  address of its payload.

``write`` hashes each page, finds the first page of each address from the
narrow digest rows, and keeps one copy of each payload per map task before
anything is shuffled.  ``read`` joins headers with payloads on the address,
checks that every payload still hashes to its address and has the length and
SHA-1 that its header states, and takes a record's fields from its header
bytes (payloads are hashed where they are stored, so a reader of fields alone
shuffles no payload); ``records`` gives the bytes of each record as a WARC file holds them.

Both joins have one row per address on one side, so an address that a third
of all records share is a skewed join, which adaptive execution splits.  All
steps are DataFrame expressions; both tables lie in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.plans.materialize import remove_folder

RESPONSE, REVISIT = "response", "revisit"
# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, BASE32HEX = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: Capture time of records, as the pages have none.
DATE = "2000-01-01T00:00:00Z"
#: Header field of the page's id (an extension field).
PAGE_FIELD = "X-Page-ID"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), BASE32HEX, BASE32)


def record_id(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def _uri(url: Column) -> Column:
    """The URL with control characters as percent escapes, so that it stays on one line."""
    escaped = url
    for code in (*range(0x20), 0x7F):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x1F\x7F]"), escaped).otherwise(url)


def _header(date: str) -> Column:
    """Exact header bytes: the WARC header, then the HTTP header that opens the block."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    first = F.col("record_type") == RESPONSE
    block = F.octet_length(http) + F.when(first, F.col("payload_bytes")).otherwise(0)
    lines = [F.lit(VERSION + CRLF), _field("WARC-Type", F.col("record_type")), _field("WARC-Record-ID", F.col("record_id")), _field("WARC-Date", F.lit(date)),
             _field("WARC-Target-URI", _uri(F.col("url"))), _field(PAGE_FIELD, F.col("page_id")), _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
             _field("WARC-Profile", F.when(~first, F.lit(PROFILE))), _field("WARC-Refers-To", F.when(~first, F.col("response_id"))),
             _field("Content-Type", F.lit("application/http; msgtype=response")), _field("Content-Length", block), F.lit(CRLF)]
    return F.encode(F.concat(*lines, http), "utf-8")


def write(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Write an archive of ``pages(page_id, url, html)`` to a folder.

    One record per row.  Of the records with equal payloads of at least
    ``min_bytes`` bytes that with the smallest page id (a null id is last,
    then the smaller URL) is the response and the others revisit it; smaller
    payloads are all responses.  Rows that repeat are records of their own,
    one of which is the response.  A null html is an empty payload, a null
    URL or page id has no header line; other columns do not take part; an
    empty table gives an empty archive.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    digests = rows.select("page_id", "url", F.sha2("payload", 256).alias("address"), base32_sha1(F.col("payload")).alias("sha1"),
                          F.octet_length("payload").cast("long").alias("payload_bytes"), F.monotonically_increasing_id().alias("row"))
    digests.write.mode("overwrite").parquet(f"{folder}/digests")  # fixes each row's number
    digests = spark.read.schema(digests.schema).parquet(f"{folder}/digests")
    named = digests.withColumn("record_id", record_id(F.col("page_id"), F.col("url"), F.col("address"), F.col("row")))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url", "row", "record_id")
    first = named.groupBy("address").agg(F.min(order).alias("first"), F.min("payload_bytes").alias("low"), F.max("payload_bytes").alias("high"),
                                         F.min("sha1").alias("sha1_low"), F.max("sha1").alias("sha1_high"))
    same = (F.col("low") == F.col("high")) & (F.col("sha1_low") == F.col("sha1_high"))
    first = first.select("address", F.when(same, F.col("first")).otherwise(F.raise_error(F.concat(F.lit("payloads differ under "), "address"))).alias("first"))
    typed = (named.join(first, "address")
             .withColumn("record_type", F.when((F.col("payload_bytes") >= min_bytes) & (F.col("row") != F.col("first.row")), REVISIT).otherwise(RESPONSE))
             .withColumn("response_id", F.col("first.record_id")))
    typed.select("address", _header(date).alias("header")).write.mode("overwrite").parquet(f"{folder}/headers")
    content = rows.groupBy(F.sha2("payload", 256).alias("address")).agg(F.any_value("payload").alias("payload"))
    (content.join(first, "address").select("address", "payload", F.col("first.record_id").alias("response_id"), F.col("first.page_id").alias("response_page"))
     .write.mode("overwrite").parquet(f"{folder}/payloads"))
    remove_folder(spark, f"{folder}/digests")


HEADERS = "address string, header binary"
PAYLOADS = "address string, payload binary, response_id string, response_page long"


def value(header: Column, name: str) -> Column:
    """A field's value in the WARC header; null without such a line."""
    warc = F.substring_index(header, CRLF + CRLF, 1)
    found = F.regexp_extract(warc, f"(?i)\\r\\n{name}: ([^\\r\\n]*)", 1)
    return F.when(found != "", found)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: page_id, url (as in the header), record_type,
    refers_to (page id of the response, for revisits), payload_digest and
    payload_bytes of the payload found, payload, header, address.

    A payload that does not hash to its address, a header that states another
    digest or length, a header without its payload and a revisit of an unknown
    record are errors.
    """
    headers = spark.read.schema(HEADERS).parquet(f"{folder}/headers")
    payloads = spark.read.schema(PAYLOADS).parquet(f"{folder}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload differs from address "), "address"))
    digest = F.when(F.sha2("payload", 256) == F.col("address"), base32_sha1(F.col("payload"))).otherwise(wrong)
    content = payloads.select("*", digest.alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    text = F.decode("header", "utf-8")
    http_bytes = F.regexp_extract(text, "(?s)\\r\\n\\r\\n.*\\r\\nContent-Length: ([0-9]+)\\r\\n\\r\\n$", 1).cast("long")
    j = headers.join(content, "address", "left").withColumn("record_type", value(text, "WARC-Type")).withColumn("_refers", value(text, "WARC-Refers-To"))
    stated = (F.concat(F.lit("sha1:"), "payload_digest").eqNullSafe(value(text, "WARC-Payload-Digest"))
              & F.col("payload_bytes").eqNullSafe(http_bytes)
              & ((F.col("record_type") == RESPONSE) | F.col("_refers").eqNullSafe(F.col("response_id"))))
    checked = F.when(stated, F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("header and payload differ for "), "address")).cast("long"))
    return j.select(value(text, PAGE_FIELD).cast("long").alias("page_id"), value(text, "WARC-Target-URI").alias("url"), "record_type",
                    F.when(F.col("record_type") == REVISIT, F.col("response_page")).alias("refers_to"), "payload_digest",
                    checked.alias("payload_bytes"), "payload", "header", "address")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """``read`` with ``record``: the record's bytes as in a WARC file (a revisit
    has no payload there) and ``original``: the same capture as a response."""
    end = F.encode(F.lit(CRLF + CRLF), "utf-8")
    text = F.decode("header", "utf-8")
    http = F.octet_length(F.substring_index(text, CRLF + CRLF, -2))
    length = F.concat(F.lit(f"{CRLF}Content-Length: "), (http + F.col("payload_bytes")).cast("string"), F.lit(CRLF + CRLF))
    warc = F.substring_index(text, CRLF + CRLF, 1)
    whole = F.regexp_replace(warc, f"\\r\\n(WARC-Profile|WARC-Refers-To|Content-Length): [^\\r\\n]*", "")
    whole = F.regexp_replace(whole, f"\\r\\nWARC-Type: {REVISIT}", f"\r\nWARC-Type: {RESPONSE}")
    first = F.col("record_type") == RESPONSE
    original = F.concat(F.encode(F.concat(whole, length, F.substring_index(text, CRLF + CRLF, -2)), "utf-8"), "payload", end)
    return read(spark, folder).select("*", F.when(first, F.concat("header", "payload", end)).otherwise(F.concat("header", end)).alias("record"),
                                      F.when(first, F.concat("header", "payload", end)).otherwise(original).alias("original"))
