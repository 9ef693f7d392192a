"""A content-addressed WARC archive: payload bytes are stored once under their SHA-256,
exact record headers apart from them, and whole records come back through a join.

``write_archive`` writes two Parquet tables below a folder: ``records`` (record_id,
payload_key, header: the exact header block up to and with its blank line) and
``payloads`` (payload_key, payload). ``read_archive`` joins them, recomputes the digest of
every stored payload and fails on a payload that doesn't match its key, so that a record
comes back byte for byte or not at all.

Of records with equal payloads the one with the largest id holds the payload (a
``response``), the others are ``revisit`` records that refer to it.

Defined cases: null text is an empty payload; an id of null counts as the smallest; rows
that repeat id and payload are the same record, so all of them are responses if their id
is the largest (their payload is stored once); an empty table makes an empty archive;
other columns of the input are not archived. A payload below ``min_bytes`` is always
stored with its own response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The digits of conv() in base 32 and those of RFC 4648.
BASE32_DIGITS = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary ``data``: 160 bits are four groups of 40,
    each eight base-32 digits."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), *BASE32_DIGITS)


def record_urn(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">"))


def _header_value(text: Column) -> Column:
    """Percent-encodes what would end a header line."""
    return F.replace(F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def warc_header(record_id: Column, uri: Column, kind: Column, refers_to: Column, digest: Column, length: Column) -> Column:
    """The header block of a WARC 1.1 record. A revisit has no block of its own, so its
    Content-Length is 0; the length of the full payload stands in WARC-Payload-Length."""
    revisit = kind == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_urn(record_id)),
        F.concat(F.lit("WARC-Target-URI: "), _header_value(uri)),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.concat(F.lit("WARC-Payload-Length: "), length.cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_urn(refers_to))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(length.cast("string"))),
    ]  # concat_ws leaves out the null lines
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, path: str, *, record_id: str = "page_id", uri: str = "url", payload: str = "html",
                  min_bytes: int = 0) -> None:
    """Archive every row of ``pages`` below ``path``.

    The digests are aggregated before any payload moves: only (key, id) pairs are shuffled,
    with partial aggregation, so one payload with a third of all rows is no hot group."""
    body = F.coalesce(F.col(payload).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(record_id).alias("id"), F.col(uri).alias("uri"), body.alias("payload"))
    rows = rows.withColumn("payload_key", F.sha2("payload", 256))
    length = F.octet_length("payload").cast("long").alias("length")
    narrow = materialised(rows.select("id", "uri", "payload_key", length, base32_sha1(F.col("payload")).alias("digest")), "digests")
    owners = narrow.groupBy(F.col("payload_key").alias("k")).agg(F.max("id").alias("owner"))
    first = F.col("id").eqNullSafe(F.col("owner")) | (F.col("length") < min_bytes)
    kind = F.when(first, F.lit("response")).otherwise(F.lit("revisit"))
    narrow.join(owners, F.col("payload_key") == F.col("k")).select(
        F.col("id").alias("record_id"), "payload_key",
        warc_header(F.col("id"), F.col("uri"), kind, F.col("owner"), F.col("digest"), F.col("length")).alias("header"),
    ).write.parquet(f"{path}/records")
    # The bytes of a key come from its owner's row: the join by key and id spreads the
    # copies over all tasks, and what is left of a key are repeated rows of one id.
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    owned = owners.select(F.col("k").alias("payload_key"), name("owner").alias("name"))
    rows.select("payload_key", name("id").alias("name"), "payload").join(owned, ["payload_key", "name"]).dropDuplicates(
        ["payload_key", "name"]).select("payload_key", "payload").write.parquet(f"{path}/payloads")


def payload_index(spark: SparkSession, path: str) -> DataFrame:
    """(payload_key, payload, payload_bytes, payload_digest) of every stored payload, each
    checked against the strong digest it is stored under."""
    stored = spark.read.parquet(f"{path}/payloads")
    fine = F.sha2("payload", 256) == F.col("payload_key")
    key = F.when(fine, F.col("payload_key")).otherwise(
        F.raise_error(F.concat(F.lit("payload doesn't match its digest: "), F.col("payload_key"))))
    return stored.select(
        key.alias("payload_key"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"))


def header_field(name: str) -> Column:
    """The value of one header line; null if there is no such line."""
    found = F.regexp_extract("header", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(F.col("header").contains(f"{CRLF}{name}: "), found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record, read back: record_id, record_type, refers_to (the id as text), uri,
    payload (of a revisit: that of the record it refers to), payload_bytes,
    payload_digest and record (the exact bytes of header, block and end mark)."""
    records = spark.read.parquet(f"{path}/records")
    joined = records.join(payload_index(spark, path), "payload_key")
    kind = header_field("WARC-Type")
    block = F.when(kind == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.select(
        "record_id", kind.alias("record_type"),
        F.regexp_extract(header_field("WARC-Refers-To"), "^<urn:page:(.*)>$", 1).alias("refers_to"),
        header_field("WARC-Target-URI").alias("uri"), "payload", "payload_bytes", "payload_digest",
        (F.substring_index(header_field("WARC-Payload-Digest"), ":", -1) == F.col("payload_digest")).alias("verified"),
        F.concat(F.col("header").cast("binary"), block, F.lit(b"\r\n\r\n")).alias("record"))
