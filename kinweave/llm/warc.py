"""Content-addressed WARC archive.

Two tables in one folder: ``payloads`` holds the bytes of every distinct payload
once, under its SHA-256 and length, after a check that a second digest (SHA-1) of all
payloads under it is one too;
``headers`` holds the exact header block of every record and the digest of its
payload. The original records come back through a join of the two.

Nulls: a null html is an empty payload, a null url an empty target, a null id
is written as an empty id and counts after all others. Rows that repeat the
smallest id of a payload are responses too, as a revisit cannot refer to
itself. Empty tables give empty archives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _util

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(hex_digest: Column) -> Column:
    """Upper-case base32 of 40 hex digits: 5 hex digits are 4 base32 digits."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _with_digests(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_col).alias("record_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), body.alias("payload")
    ).select("*", F.sha2("payload", 256).alias("digest"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = DATE) -> str:
    """Write an archive of one record per row under ``path`` and return the path.

    Payloads of fewer than ``min_bytes`` are always response records."""
    recs = _with_digests(pages, id_col, url_col, payload_col)
    # a payload that fills a third of the table is one row per task after the partial aggregation;
    # a second digest tells whether all payloads under a digest are one
    store = recs.groupBy("digest", "n_bytes").agg(
        F.max("payload").alias("payload"), F.min("sha1").alias("sha1"), F.max("sha1").alias("other"), F.min("record_id").alias("first_id")
    )
    same = F.assert_true(F.col("sha1") == F.col("other"), F.concat(F.lit("two payloads under digest "), F.col("digest")))
    store = store.filter(same.isNull()).select("digest", "n_bytes", base32_of_hex(F.col("sha1")).alias("sha1"), "first_id", "payload")
    store.write.parquet(f"{path}/payloads")
    known = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "n_bytes", "sha1", "first_id")
    # the sort-merge join of a hot digest is split by adaptive execution: only the narrow side repeats
    joined = recs.drop("payload", "sha1").join(known, ["digest", "n_bytes"])
    revisit = ~F.col("record_id").eqNullSafe(F.col("first_id")) & (F.col("n_bytes") >= min_bytes)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes"), F.lit("\r\n\r\n"))
    block = F.when(revisit, F.length(http)).otherwise(F.length(http) + F.col("n_bytes"))
    lines = [
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("record_id"))),
        F.concat(F.lit("WARC-Date: "), F.lit(date)),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", " ")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first_id")))),
        F.when(revisit, F.concat(F.lit("WARC-Profile: "), F.lit(PROFILE))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    header = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), http)
    joined.select("digest", "n_bytes", header.cast("binary").alias("header")).write.parquet(f"{path}/headers")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: ``header`` (binary), ``payload`` (the full one, of
    revisits too) and what the headers say. The digest is taken again from the
    bytes that came back and must be the header's."""
    joined = spark.read.parquet(f"{path}/headers").join(
        spark.read.parquet(f"{path}/payloads").select("digest", "n_bytes", "payload"), ["digest", "n_bytes"], "left"
    )
    text = F.decode("header", "UTF-8")
    field = lambda k: F.regexp_extract(text, rf"\r\n{k}: ([^\r\n]*)\r\n", 1)
    ident = lambda k: F.regexp_extract(text, rf"\r\n{k}: <urn:page:([^>\r\n]*)>\r\n", 1)
    digest = base32_of_hex(F.sha1("payload"))
    checked = F.assert_true(
        F.coalesce((F.sha2("payload", 256) == F.col("digest")) & (field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), digest)), F.lit(False)),
        F.lit("a payload is missing or is not what its record's header says"),
    )
    return joined.filter(checked.isNull()).select(
        F.nullif(ident("WARC-Record-ID"), F.lit("")).alias("record_id"),
        field("WARC-Type").alias("record_type"),
        F.nullif(ident("WARC-Refers-To"), F.lit("")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        "header",
        "payload",
    )


def records(archive: DataFrame) -> DataFrame:
    """Original record bytes: header block, then the payload of responses, then two line ends."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return archive.select("record_id", F.concat("header", body, F.lit("\r\n\r\n").cast("binary")).alias("record"))


def export_files(archive: DataFrame, path: str) -> None:
    """Plain gzipped WARC files, one per partition."""
    body = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise(F.lit(""))
    archive.select(F.concat(F.decode("header", "UTF-8"), body)).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def digest(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder, read it back, report each page."""
    kind = dict(pages.dtypes)["page_id"]
    path = write(pages, _util.shared_dir(pages.sparkSession), min_bytes=min_bytes)
    return read(pages.sparkSession, path).select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
