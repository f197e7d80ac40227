"""Content-addressed WARC archive.

Each page becomes one WARC/1.1 record. The archive is two tables: ``records``
holds every record's exact header bytes and the SHA-256 of its payload,
``payloads`` holds the bytes behind each SHA-256 once. Reading checks each
payload against its digest and joins the two back into whole records.

Of records with equal payloads of ``min_bytes`` or more, the one with the
largest page_id is a response and the others revisit it; shorter payloads are
always responses (their bytes are still stored once).

Only digests and ids meet by payload, after a pre-aggregation, so a payload
that a third of all pages share costs no task more than others. Payload bytes
are dealt by page, and the page that holds them writes them; the shuffle files
go with each write, so those of the writes and of a read never lie side by side.

Defined results: a null html is an empty payload; a null page_id is a record
whose id reads ``none``, it ranks below every other and never refers; repeated
rows are records of their own, and all rows of the largest page_id are
responses; other columns are ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import NULL_ID, shared_path, write_table

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "<urn:x-page:"


@dataclass(frozen=True)
class Archive:
    records: str
    payloads: str


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _urn(id_: Column) -> Column:
    return _text(_URN, F.coalesce(F.when(id_ != NULL_ID, id_.cast("string")), F.lit("none")), ">")


def _header(kind: Column) -> Column:
    """Header bytes of a record: WARC fields, blank line and the HTTP head of its block."""
    http = _text("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.col("payload_bytes").cast("string"), "\r\n\r\n")
    held = F.when(kind == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("urn:x-none")), "[\\r\\n]+", " ")
    refers = F.when(kind == "revisit", _text("WARC-Refers-To: ", _urn(F.col("holder")), "\r\nWARC-Profile: " + PROFILE + "\r\n")).otherwise(F.lit(""))
    return _text(
        "WARC/1.1\r\nWARC-Type: ", kind, "\r\nWARC-Record-ID: ", _urn(F.col("page_id")), "\r\nWARC-Date: " + DATE + "\r\nWARC-Target-URI: ", url,
        "\r\nWARC-Payload-Digest: sha1:", F.col("sha1"), "\r\nX-Payload-Length: ", F.col("payload_bytes").cast("string"), "\r\n", refers,
        "Content-Type: application/http; msgtype=response\r\nContent-Length: ", (F.length(http) + held).cast("string"), "\r\n\r\n", http,
    )


def write_archive(pages: DataFrame, path: str | None = None, min_bytes: int = 1000) -> Archive:
    spark = pages.sparkSession
    base = path or shared_path(spark, "warc")
    archive = Archive(f"{base}/records", f"{base}/payloads")
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    full = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_ID)).alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digests = full.select("page_id", "url", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    holders = digests.groupBy("sha256").agg(F.max("page_id").alias("holder"))
    kind = F.when((F.col("payload_bytes") < min_bytes) | (F.col("page_id") == F.col("holder")), "response").otherwise("revisit")
    records = digests.join(holders, "sha256").withColumn("kind", kind)
    write_table(records.select("page_id", F.encode(_header(F.col("kind")), "UTF-8").alias("header"), "sha256", "holder"), archive.records)
    # One row per digest: the page that holds it. Repeated rows of that page are equal, so any one serves.
    stored = spark.read.parquet(archive.records).filter(F.col("page_id") == F.col("holder")).select("page_id", "sha256").distinct()
    held = full.select("page_id", "payload", F.sha2("payload", 256).alias("sha256")).join(stored.hint("shuffle_hash"), ["page_id", "sha256"], "left_semi")
    write_table(held.dropDuplicates(["page_id", "sha256"]).select("sha256", "payload"), archive.payloads)
    return archive


def _field(name: str) -> Column:
    return F.regexp_extract("head", f"(?:^|\\r\\n){name}: ([^\\r\\n]*)\\r\\n", 1)


def read_headers(spark: SparkSession, archive: Archive) -> DataFrame:
    """Header fields of every record, from its stored header bytes alone."""
    rows = spark.read.parquet(archive.records).select("header", "sha256", F.decode("header", "UTF-8").alias("head"))
    page = F.expr(f"try_cast(substring_index(substring_index({'{}'}, '{_URN}', -1), '>', 1) as long)".format("record_id"))
    refers = F.expr(f"try_cast(substring_index(substring_index({'{}'}, '{_URN}', -1), '>', 1) as long)".format("refers"))
    fields = rows.select("header", "sha256", _field("WARC-Type").alias("record_type"), _field("WARC-Record-ID").alias("record_id"), _field("WARC-Refers-To").alias("refers"), _field("WARC-Target-URI").alias("url"), F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"), _field("X-Payload-Length").cast("long").alias("payload_bytes"))
    return fields.select(page.alias("page_id"), "url", "record_type", F.when(F.col("record_type") == "revisit", refers).alias("refers_to"), "payload_digest", "payload_bytes", "header", "sha256")


def verified_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """(sha256, payload, sha1, bytes); a payload that its digest doesn't match stops the read."""
    rows = spark.read.parquet(archive.payloads)
    wrong = F.raise_error(_text("payload does not match its digest ", F.col("sha256")))
    rows = rows.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(wrong.cast("binary")))
    return rows.select("sha256", "payload", F.sha1("payload").alias("stored_sha1"), F.octet_length("payload").cast("long").alias("stored_bytes"))


def read_archive(spark: SparkSession, archive: Archive, payload: bool = True) -> DataFrame:
    """Every record with its fields; with ``payload`` also the full payload and the record's bytes.

    ``payload_digest`` and ``payload_bytes`` come from the stored bytes and must agree with the header.
    """
    heads = read_headers(spark, archive)
    bodies = verified_payloads(spark, archive)
    if not payload:
        bodies = bodies.drop("payload")
    joined = heads.join(bodies, "sha256")
    agree = (F.col("stored_sha1") == F.col("payload_digest")) & (F.col("stored_bytes") == F.col("payload_bytes"))
    wrong = F.raise_error(F.lit("a record's header does not match its payload"))
    joined = joined.withColumn("payload_digest", F.when(agree, F.col("stored_sha1")).otherwise(wrong.cast("string"))).drop("stored_sha1", "stored_bytes", "sha256")
    if payload:
        body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
        joined = joined.withColumn("record", F.concat("header", body, F.lit(b"\r\n\r\n")))
    return joined


def parse_records(rows: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes, payload_digest and record_bytes from the bytes of rebuilt records.

    A response's payload is what its record holds, a revisit's is the one behind its digest. Digest and
    length are computed from those bytes; a record that is longer or shorter than its header says stops the read.
    """
    head = F.substring_index(F.decode("record", "ISO-8859-1"), "\r\n\r\n", 1)
    field = lambda name: F.regexp_extract(F.concat("fields", F.lit("\r\n")), f"(?:^|\\r\\n){name}: ([^\\r\\n]*)\\r\\n", 1)
    number = lambda urn: F.expr(f"try_cast(substring_index(substring_index({urn}, '{_URN}', -1), '>', 1) as long)")
    rows = rows.select("record", "payload", head.alias("fields")).withColumns({"kind": field("WARC-Type"), "id": field("WARC-Record-ID"), "to": field("WARC-Refers-To"), "length": field("Content-Length").cast("long")})
    at = F.char_length("fields") + 5  # fields are read byte by byte, so characters count bytes
    block = F.substr("record", at, F.octet_length("record") - at - 3)
    rows = rows.withColumn("block", block)
    body_at = F.expr("position(X'0D0A0D0A', block) + 4")
    body = F.when(F.col("kind") == "response", F.expr("substring(block, position(X'0D0A0D0A', block) + 4)")).otherwise(F.col("payload"))
    right = (F.octet_length("block") == F.col("length")) & (body_at > 4)
    wrong = F.raise_error(F.lit("a record's length is not that of its header")).cast("binary")
    rows = rows.withColumn("body", F.when(right, body).otherwise(wrong))
    return rows.select(
        number("id").alias("page_id"), F.col("kind").alias("record_type"), F.when(F.col("kind") == "revisit", number("to")).alias("refers_to"),
        F.octet_length("body").cast("long").alias("payload_bytes"), F.sha1("body").alias("payload_digest"), F.octet_length("record").cast("long").alias("record_bytes"),
    )
