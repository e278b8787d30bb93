"""WARC records kept content-addressed: each payload once, headers apart.

An archive is a folder of two tables. ``payloads`` has one row for each distinct
payload under its SHA-256; ``headers`` has one row for each record with its exact
header bytes and the digest. Joined on the digest they give the original records
back, byte for byte. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biomeframe.session import scratch_path

#: Fixed values of WARC/1.1.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 upper-case base-32 characters: five hex digits are four of them."""
    digest = F.sha1(payload)
    out = []
    for k in range(8):
        word = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            code = F.shiftright(word, shift).bitwiseAND(F.lit(31))
            out.append(F.substring(F.lit(BASE32), code + 1, F.lit(1)))
    return F.concat(*out)


def _one_line(value: Column) -> Column:
    """A header value: line breaks and other controls would end the field, so they are
    percent-encoded, as is the percent sign."""
    out = F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit("%"), F.lit("%25"))
    for code in (*range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def _plain(value: Column) -> Column:
    for code in (127, *range(31, -1, -1)):
        value = F.replace(value, F.lit(f"%{code:02X}"), F.lit(chr(code)))
    return F.replace(value, F.lit("%25"), F.lit("%"))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
) -> None:
    """Write a record for each row of ``pages`` to the archive at ``path``.

    Of the records with one payload of at least ``least_bytes`` bytes, that with
    the largest page_id is the response, the others are revisits of it; a null
    page_id is smaller than any. Shorter payloads are all responses. A null html
    is an empty payload. Rows repeated with the same page_id are records of
    their own with the same type. Two payloads with one SHA-256 stop the job.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    check = F.struct(F.length("payload").alias("n"), F.crc32("payload").alias("c"))
    owners = rows.groupBy("digest").agg(
        F.max("page_id").alias("owner"),
        F.min(check).alias("low"), F.max(check).alias("high"),
        F.first("payload").alias("payload"),
    )
    clash = F.raise_error(F.lit("two payloads have the same digest")).cast("binary")
    owners.select(
        "digest", "owner", F.when(F.col("low") == F.col("high"), F.col("payload"))
        .otherwise(clash).alias("payload"),
    ).write.parquet(f"{path}/payloads")
    stored_owners = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "owner")
    facts = rows.select(
        "page_id", "url", "digest", F.length("payload").cast("long").alias("n"),
        base32_sha1(F.col("payload")).alias("sha1"),
    ).join(stored_owners, "digest")
    revisit = (F.col("n") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("owner"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_END))
    none = F.lit("")
    header = F.concat(
        F.lit(f"{VERSION}{_END}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Target-URI", _one_line(F.col("url"))),
        line("WARC-Date", F.lit(EPOCH)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", _record_id(F.col("owner"))),
            line("WARC-Profile", F.lit(REVISIT_PROFILE)),
        )).otherwise(none),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit(_END),
    )
    facts.select(F.encode(header, "utf-8").alias("header"), "digest").write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive: header (binary), record (the exact bytes of the WARC
    record, which of a revisit has no content) and payload (whole, of revisits, too)."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    both = headers.join(payloads, "digest")
    content = F.when(
        _field("WARC-Type", F.decode("header", "utf-8")) == "revisit", F.lit("").cast("binary")
    ).otherwise(F.col("payload"))
    end = F.lit(_END * 2).cast("binary")
    return both.select(
        "header", F.concat(F.col("header"), content, end).alias("record"), "payload"
    )


def _field(name: str, header: Column) -> Column:
    """Value of a header field; null if there is none."""
    after = F.substring_index(header, f"{_END}{name}: ", -1)
    return F.when(F.contains(header, F.lit(f"{_END}{name}: ")), F.substring_index(after, _END, 1))


def records(archive: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    All from the bytes read back: the digest is that of the payload itself, and
    a record whose own digest or length field says otherwise stops the job.
    """
    text = archive.select(F.decode("header", "utf-8").alias("h"), "payload")
    own = base32_sha1(F.col("payload"))
    wrong = F.raise_error(F.lit("a payload differs from the digest of its record"))
    page = lambda value: F.nullif(
        F.regexp_extract(value, r"<urn:page:(-?\d+)>", 1), F.lit("")
    ).cast("long")
    return text.select(
        page(_field("WARC-Record-ID", F.col("h"))).alias("page_id"),
        _plain(_field("WARC-Target-URI", F.col("h"))).alias("url"),
        _field("WARC-Type", F.col("h")).alias("record_type"),
        page(_field("WARC-Refers-To", F.col("h"))).alias("refers_to"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(
            F.concat(F.lit("sha1:"), own) == _field("WARC-Payload-Digest", F.col("h")), own
        ).otherwise(wrong.cast("string")).alias("payload_digest"),
        "payload",
    )


def archived(pages: DataFrame, **names) -> DataFrame:
    """``pages`` written to a new archive in the shared folder and read back as ``records``."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path, **names)
    return records(read_archive(spark, path))
