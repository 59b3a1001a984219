"""Content-addressed web archive: payload bytes once by strong digest, exact record headers beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The digit alphabets of base 32 (as conv() writes it, and RFC 4648), and the record names of WARC 1.1.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:ledgerline:page:"


def base32(hex_digest: Column, hex_chars: int = 40) -> Column:
    """Hex digits as base 32: five hex digits are four of base 32."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, i + 1, 5), 16, 32), 4, "0") for i in range(0, hex_chars, 5)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def archive_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, sha256, record_type, refers_to, header): one WARC record per row, without its block.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the largest id is the response and the
    others revisit it; rows repeated under that id are responses too. A null payload is empty, a null URL stays out of
    the header, line breaks in a URL are escaped. Rows with a null id cannot be named and raise nothing: they are
    responses of their own with an empty name. Payloads with one SHA-256 must agree in length and SHA-1, else it fails.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    facts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.sha2(payload, 256).alias("sha256"), F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))
    # Only digests meet here; a payload that a third of all pages share is one row per task after the partial maximum.
    groups = facts.groupBy("sha256").agg(F.max("page_id").alias("first_id"), F.min("sha1").alias("a"), F.max("sha1").alias("b"), F.min("size").alias("c"), F.max("size").alias("d"))
    same = F.when((F.col("a") == F.col("b")) & (F.col("c") == F.col("d")), F.col("first_id")).otherwise(F.raise_error(F.lit("two payloads share a SHA-256")).cast("long"))
    met = facts.join(groups.select("sha256", same.alias("first_id")), "sha256")
    revisit = (F.col("size") >= min_bytes) & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first_id"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    clean = F.regexp_replace("url", r"[\r\n]", "%0A")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        F.coalesce(line("WARC-Target-URI", clean), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        F.when(F.col("record_type") == "revisit", F.concat(line("WARC-Refers-To", F.concat(F.lit(f"<{ID_PREFIX}"), F.col("first_id").cast("string"), F.lit(">"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        line("Content-Length", F.when(F.col("record_type") == "revisit", F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )
    refers = F.when(F.col("record_type") == "revisit", F.col("first_id")).alias("refers_to")
    return met.withColumn("record_type", kind).select("page_id", "sha256", "record_type", refers, F.encode(header, "UTF-8").alias("header"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, broadcast_rows: int = 1_000_000) -> None:
    """Write ``records`` (exact headers) and ``payloads`` (bytes, once per digest) under ``path``.

    The page that keeps a payload is found from digests alone. Its bytes are then picked straight from the scan: the
    list of keeping pages is broadcast while it has at most ``broadcast_rows`` rows (8 bytes each), joined beyond that.
    """
    spark = pages.sparkSession
    archive_records(pages, id_col, url_col, payload_col, min_bytes).write.mode("overwrite").parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    keep = records.groupBy("sha256").agg(F.max("page_id").alias("keeper"))
    if keep.count() <= broadcast_rows:
        keep = F.broadcast(keep)
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    held = pages.select(F.col(id_col).alias("page_id"), payload.alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    held = held.join(keep, "sha256").where(F.col("page_id").eqNullSafe(F.col("keeper"))).select("sha256", "payload")
    held.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, payload, sha1, size): each payload checked against the digest that names it."""
    held = spark.read.parquet(f"{path}/payloads")
    good = F.when(F.sha2("payload", 256) == F.col("sha256"), F.sha1("payload")).otherwise(F.raise_error(F.lit("payload differs from its digest")))
    return held.select("sha256", "payload", good.alias("sha1"), F.octet_length("payload").cast("long").alias("size")).dropDuplicates(["sha256"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: the fields read from its header, its payload, and ``record``, the exact WARC bytes.

    A revisit's payload is that of the record it refers to; its own block is empty. Columns that are not asked for are
    not read: without ``payload`` and ``record`` only digests cross the network.
    """
    head = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        found = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def named(name: str) -> Column:
        return F.nullif(F.regexp_extract(field(name), rf"^<{ID_PREFIX}(.*)>$", 1), F.lit("")).cast("long")

    records = spark.read.parquet(f"{path}/records").select(
        "sha256", "header",
        named("WARC-Record-ID").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        named("WARC-Refers-To").alias("refers_to"),
    )
    met = records.join(read_payloads(spark, path), "sha256", "left")
    digest = F.when(base32(F.col("sha1")) == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("header and payload disagree")))
    block = F.when(F.col("record_type") == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    return met.select("page_id", "url", "record_type", digest.alias("payload_digest"), F.col("size").alias("payload_bytes"), "refers_to", "payload", F.concat("header", block, end).alias("record"))
