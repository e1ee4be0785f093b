"""Content-addressed web archive in the WARC record format.

Two tables hold the archive. ``payloads`` has every distinct payload once, under
its SHA-256; ``records`` has the exact header bytes of each record, and the
address of its payload. A record is its headers and its payload, so joining
the two gives back the original bytes. Of records with equal payloads, one is a
``response`` and the others are ``revisit`` records that name it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import kept_in_files
from millrace.session import work_path

# Fixed values of the record format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE_END = "\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: Header fields of our own: the page of a record, and that of the response.
PAGE_ID, REFERS_TO = "Page-ID", "Refers-To-Page-ID"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(digest: Column) -> Column:
    """Bare base-32 text of a hexadecimal digest of whole 40-bit groups (SHA-1)."""
    groups = [F.conv(F.substr(digest, F.lit(1 + 10 * i), F.lit(10)), 16, 10).cast("long") for i in range(4)]
    letters = [
        F.substr(
            F.lit(BASE32),
            (F.shiftright(group, 35 - 5 * i).bitwiseAND(F.lit(31)) + 1).cast("int"),
            F.lit(1),
        )
        for group in groups
        for i in range(8)
    ]
    return F.concat(*letters)


def _safe(text: Column) -> Column:
    """Header text without line ends, which would end the header."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x1F\x7F]", "%20")


def _record_uri(number: Column) -> Column:
    """A record's id as a name-based URI."""
    h = F.sha1(number.cast("string"))
    cut = [F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(
    pages: DataFrame, path: str, *, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write ``pages(page_id, url, html)`` as an archive below ``path``.

    The payload is the html in UTF-8; a null html is an empty payload and a null
    url an empty target. Payloads of fewer than ``least_bytes`` bytes are not
    revisited. The response of equal payloads is the record of the largest
    page id, of equal or null ids the last one read; repeated rows are records
    of their own. Control characters in a url become ``%20``. Other columns are not read.

    Raises an error if one SHA-256 stands for payloads of different length or
    SHA-1.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(
        "page_id",
        F.col("url").cast("string").alias("url"),
        F.sha2(html, 256).alias("address"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1(html)).alias("payload_digest"),
        F.monotonically_increasing_id().alias("record_no"),
    )
    # Written first: record numbers must not change when a task is repeated.
    base = kept_in_files(base, "archive-rows")
    small = F.col("payload_bytes") < least_bytes
    first = base.groupBy("address").agg(
        F.max(F.struct("page_id", "record_no")).alias("top"),
        F.min(F.struct("payload_bytes", "payload_digest")).alias("least"),
        F.max(F.struct("payload_bytes", "payload_digest")).alias("most"),
    )
    same = F.raise_error(F.concat(F.lit("digest of unequal payloads: "), F.col("address")))
    first = first.select(
        "address",
        F.when(F.col("least") == F.col("most"), F.col("top")).otherwise(same.cast("void").cast(first.schema["top"].dataType)).alias("top"),
    )
    # Written, so that a payload of very many pages can be split.
    joined = base.join(kept_in_files(first, "archive-responses"), "address")
    response = small | (F.col("top.record_no") == F.col("record_no"))
    uri = _record_uri(F.col("record_no"))
    http = F.concat(
        F.lit(HTTP_HEAD + "Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(LINE_END * 2),
    )

    def line(name: str, value: Column | str) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.concat(F.lit(f"{name}: "), value, F.lit(LINE_END))

    def optional(name: str, value: Column) -> list[Column]:
        """No line for a null id."""
        return [F.when(value.isNotNull(), line(name, _safe(value.cast("string")))).otherwise(F.lit(""))]

    def head(kind: str, more: list[Column], block: Column) -> Column:
        return F.concat(
            F.lit(VERSION + LINE_END),
            line("WARC-Type", kind),
            line("WARC-Record-ID", uri),
            line("WARC-Target-URI", _safe(F.col("url"))),
            line("WARC-Date", date),
            *optional(PAGE_ID, F.col("page_id")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            *more,
            line("Content-Type", "application/http; msgtype=response"),
            line("Content-Length", block.cast("string")),
            F.lit(LINE_END),
            http,
        )

    http_bytes = F.octet_length(http)
    headers = F.when(
        response, head("response", [], http_bytes + F.col("payload_bytes"))
    ).otherwise(
        head(
            "revisit",
            [
                line("WARC-Profile", REVISIT_PROFILE),
                line("WARC-Refers-To", _record_uri(F.col("top.record_no"))),
                *optional(REFERS_TO, F.col("top.page_id")),
            ],
            http_bytes,
        )
    )
    joined.select(
        "record_no",
        "address",
        F.encode(headers, "UTF-8").alias("headers"),
    ).write.parquet(f"{path}/records")
    # Equal payloads meet in the scanning task already, before any shuffle.
    pages.select(F.sha2(html, 256).alias("address"), html.alias("payload")).groupBy(
        "address"
    ).agg(F.first("payload").alias("payload")).select(
        "address", F.encode("payload", "UTF-8").alias("payload")
    ).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Every record of an archive with its payload, whatever its type.

    Columns: record_no, page_id, refers_to, headers and payload (bytes), record
    (the bytes in an archive file), record_type, url, payload_bytes and
    payload_digest (of the payload read). All but the number and the payload
    come from the headers. Raises an error where a payload is missing, or is not
    what its address and its headers say, and where a record is not as long as
    its headers say.
    """
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads")
    both = records.join(payloads, "address", "left")
    text = F.decode("headers", "UTF-8")

    def header(name: str) -> Column:
        return F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)

    def page(name: str) -> Column:
        found = header(name)
        return F.when(found != "", found).cast(id_type)

    kind = header("WARC-Type")
    empty = F.encode(F.lit(""), "UTF-8")
    end = F.encode(F.lit(LINE_END * 2), "UTF-8")
    body = F.when(kind == "response", F.col("payload")).otherwise(empty)
    # The block begins behind the first empty line.
    http = F.octet_length(F.substring_index(text, LINE_END * 2, 1)) + 4
    read = both.select(
        "record_no",
        page(PAGE_ID).alias("page_id"),
        page(REFERS_TO).alias("refers_to"),
        "headers",
        "payload",
        F.concat(F.col("headers"), body, end).alias("record"),
        (
            header("Content-Length").cast("long")
            == F.octet_length("headers") - http + F.octet_length(body)
        ).alias("long_enough"),
        kind.alias("record_type"),
        header("WARC-Target-URI").alias("url"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        header("WARC-Payload-Digest").alias("told"),
        (F.sha2("payload", 256) == F.col("address")).alias("whole"),
    )
    wrong = F.concat(F.lit("payload lost or changed: record "), F.col("record_no").cast("string"))
    good = F.coalesce(
        F.col("whole")
        & F.col("long_enough")
        & (F.col("told") == F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.lit(False),
    )
    return read.select(
        "record_no",
        "page_id",
        "refers_to",
        "headers",
        "payload",
        "record",
        "record_type",
        "url",
        F.when(good, F.col("payload_bytes")).otherwise(F.raise_error(wrong).cast("long")).alias("payload_bytes"),
        "payload_digest",
    )


def archive(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read it back."""
    spark = pages.sparkSession
    path = work_path(spark, "archive")
    write_archive(pages, path, least_bytes=least_bytes)
    return read_archive(spark, path, pages.schema["page_id"].dataType.simpleString())
