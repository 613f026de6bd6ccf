"""Content-addressed web archive.

`payloads` holds the bytes of each distinct payload once, under its SHA-256; `headers` holds the exact header of each
record and the digest of its payload; `digests` names for each digest the record that is the response. A record is its
header, its payload unless it is a revisit, and two line ends: reading joins headers and payloads on the digest, after
each payload has been checked against its digest; a payload that doesn't match ends the read with an error. The payload
bytes are shuffled once, after equal ones of a task have been merged.

Null html is an empty payload. Payloads below MIN_REVISIT bytes are a response each. Of equal ones above, rows with the
smallest page_id are the response (all rows without an id, if none has one) and the others revisit it; repeated rows
give repeated records. A null url leaves its header line out, line ends in one are escaped. Empty tables give empty
archives. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 100
DATE = "2001-08-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(END))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def header(kind: Column, date: str) -> Column:
    """The record's header with the empty line that ends it, from page_id, url, digest, n_bytes and first."""
    revisit = kind == "revisit"
    url = F.regexp_replace("url", r"[\r\n]", "%0A")
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", url), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _record_id(F.col("first"))), _line("WARC-Profile", F.lit(PROFILE))))
        .otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        F.lit(END),
    )


def write_archive(pages: DataFrame, folder: str, date: str = DATE) -> None:
    """Writes `digests`, `headers` and `payloads` below the folder."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.sha2(payload, 256).alias("digest")
    records = pages.select("page_id", "url", digest, F.octet_length(payload).cast("long").alias("n_bytes"))
    firsts = records.groupBy("digest", "n_bytes").agg(F.min("page_id").alias("first"))
    firsts.write.parquet(f"{folder}/digests")
    # Read back, so that Spark can split the records of a hot digest in the join.
    firsts = spark.read.schema(firsts.schema).parquet(f"{folder}/digests").drop("n_bytes")
    repeats = (F.col("n_bytes") >= MIN_REVISIT) & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(repeats, "revisit").otherwise("response")
    records.join(firsts, "digest").select("page_id", "digest", header(kind, date).alias("header")).write.parquet(
        f"{folder}/headers"
    )
    store = pages.select(digest, payload.alias("payload")).groupBy("digest").agg(F.any_value("payload").alias("payload"))
    store.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """digest, payload, each checked."""
    stored = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    found = F.sha2("payload", 256)
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest "), "digest"))
    return stored.withColumn("digest", F.when(found == F.col("digest"), found).otherwise(wrong.cast("string")))


def _headers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("page_id long, digest string, header string").parquet(f"{folder}/headers")


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\n{name}: ([^\r]*)", 1)


def _rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, the whole record (header, payload unless it is a revisit, two line ends) and the bytes of the payload stored."""
    joined = _headers(spark, folder).join(_payloads(spark, folder), "digest")
    body = F.when(_field("WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(F.col("header").cast("binary"), body, F.lit(END * 2).cast("binary"))
    return joined.select("page_id", record.alias("record"), F.octet_length("payload").cast("long").alias("stored_bytes"))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """page_id and the whole record."""
    return _rebuilt(spark, folder).select("page_id", "record")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """What the rebuilt records say and hold: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Each record is put together again and parsed: its header up to the empty line, and its body, whose length and digest have
    to be those the header states. A revisit has no body; its payload's length is that of the payload it stands for.
    """
    head = F.substring_index(F.col("record").cast("string"), END * 2, 1)
    parsed = _rebuilt(spark, folder).withColumn("header", head)
    begin = F.octet_length("header") + len(END * 2)
    body = F.substring(F.col("record"), begin + 1, F.octet_length("record") - begin - len(END * 2))
    page = lambda name: F.regexp_extract(_field(name), "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    fields = parsed.select(
        page("WARC-Record-ID").alias("page_id"),
        F.octet_length(body).cast("long").alias("body_bytes"),
        F.sha2(body, 256).alias("body_digest"),
        "stored_bytes",
        _field("Content-Length").cast("long").alias("stated_bytes"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha256:", "").alias("stated"),
        _field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )
    revisit = F.col("record_type") == "revisit"
    sound = (F.col("body_bytes") == F.col("stated_bytes")) & (revisit | (F.col("body_digest") == F.col("stated")))
    wrong = F.raise_error(F.concat(F.lit("record does not match its header: "), "stated")).cast("string")
    return fields.select(
        "page_id",
        F.when(revisit, F.col("stored_bytes")).otherwise(F.col("body_bytes")).alias("payload_bytes"),
        F.when(sound, F.when(revisit, F.col("stated")).otherwise(F.col("body_digest"))).otherwise(wrong).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def export_warc(spark: SparkSession, folder: str, target: str) -> None:
    """The records as compressed files that any reader of web archives takes, written by Spark's text writer: the two line
    ends that close a record are its line separator."""
    whole = F.decode(F.substring("record", 1, F.octet_length("record") - 4), "UTF-8")
    read_records(spark, folder).select(whole.alias("value")).write.option("lineSep", END * 2).option(
        "compression", "gzip"
    ).text(target)
