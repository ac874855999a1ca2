"""A content-addressed web archive: every payload once, exact record headers apart.

``write`` stores two tables: ``payloads`` (digest, payload), one row for each
distinct payload under its SHA-256, and ``headers`` (digest, header), the exact
WARC header of every record. ``records`` joins them to the original records.
Payloads are checked against their digest whenever they are read; a difference
is an error.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the
smallest page_id is a response, the others revisit it; rows that repeat its
page_id are responses as well. Smaller payloads are all responses. Null html is
an empty payload, a null url an empty one. A null page_id is never the one that
others revisit, unless no other has the payload. A payload is one value, however
long. No pages give empty tables. Other columns may have any name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog.session import scratch_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_URN = "urn:x-page:"


class Archive(NamedTuple):
    headers: DataFrame
    payloads: DataFrame


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: five bits for each character."""
    code = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(code, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(first: Column, min_bytes: int) -> Column:
    """The exact header. Line breaks in a url are percent-encoded."""
    own = F.col("page_id")
    revisits = (F.col("n_bytes") >= min_bytes) & F.coalesce(first.isNotNull() & ~first.eqNullSafe(own), F.lit(False))
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(page: Column) -> Column:
        return F.concat(F.lit(f"<{_URN}"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(own)), line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisits, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn(first)))).otherwise(F.lit("")),
        line("Content-Length", F.when(revisits, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")), F.lit("\r\n"),
    )


def write(pages: DataFrame, *, min_bytes: int = 0) -> Archive:
    """Write the archive of pages (page_id, url, html) to the shared folder and open it.

    Payload bytes move once: equal payloads meet in one aggregation that is
    partial in each task, so many copies of a payload cost one for each task.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    read = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    stored = read.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first"))
    path = scratch_path(spark, "warc")
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")
    payloads = spark.read.parquet(f"{path}/payloads")
    known = read.select("page_id", "url", "digest", F.octet_length("payload").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1"))
    headers = known.join(payloads.select("digest", "first"), "digest").select("digest", _header(F.col("first"), min_bytes).alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{path}/headers")
    return Archive(spark.read.parquet(f"{path}/headers"), payloads.select("digest", "payload"))


def checked(payloads: DataFrame) -> DataFrame:
    """The payloads; one that doesn't have its digest raises an error."""
    fits = F.sha2("payload", 256) == F.col("digest")
    wrong = F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest"))).cast("binary")
    return payloads.withColumn("payload", F.when(fits, F.col("payload")).otherwise(wrong))


def field(name: str) -> Column:
    """A header field's value, null if the header hasn't it."""
    return F.nullif(F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def records(archive: Archive) -> DataFrame:
    """(header, payload, record): every original record; a revisit's payload is the one it refers to."""
    whole = archive.headers.join(checked(archive.payloads), "digest")
    own = F.when(field("WARC-Type") == "revisit", F.lit("")).otherwise(F.col("payload"))
    return whole.select("header", "payload", F.concat(F.encode("header", "UTF-8"), own.cast("binary"), F.encode(F.lit("\r\n\r\n"), "UTF-8")).alias("record"))


def index(archive: Archive) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) read back from the archive.

    Size and digest are those of the stored payload, taken once for each before the join.
    """
    facts = checked(archive.payloads).select(
        "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
    )

    def page(name: str) -> Column:
        return F.nullif(F.regexp_extract(field(name), f"^<{_URN}(.*)>$", 1), F.lit("")).cast("long")

    return archive.headers.join(facts, "digest").select(
        page("WARC-Record-ID").alias("page_id"), "payload_bytes", "payload_digest",
        field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
    )
