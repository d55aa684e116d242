"""Content-addressed archive of web records.

Payload bytes are stored once each, under their SHA-256; the exact header of every record is
kept apart from them. A join brings the original records back, headers and blocks as they were, and
every record is verified when it is read: its payload by SHA-256 and by the digest of its header,
its block by the header's length. A record's id is its page_id and the number of its row, so ids of
repeated or null page_ids differ.

Of records with equal payloads of at least min_bytes, the one with the smallest page_id (null
last, then the row read first) is a response and the others revisit it. Null html is the empty
payload. Line ends in a url are percent-encoded; a null url gives a record without target. A
repeated row is a record of its own, and revisits the first. Html of any length is one payload, never
cut; it has to fit a row. An empty table gives an empty archive.
Further columns of the input are not read.

Copies of one payload meet map-side first. Narrow rows of frequent digests are joined by broadcast
(at most 1 / HOT_SHARE of them), and on reading the payload of a frequent digest is dealt to one
salt for each salt_rows records of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.llm.common import hot_join, staged

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
HEADERS = "page_id long, header string, sha256 string, copies long"
PAYLOADS = "sha256 string, payload binary, copies long"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are four groups of ten hexadecimal digits, eight of base 32 each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), _CONV, BASE32)


def _record_id(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), row.cast("string"), F.lit(">"))


def header(date: str) -> Column:
    """The header lines of a record from page_id, url, _row, _bytes, _sha1, record_type, refers_to, _refers_row."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("_row"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("_refers_row"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("_bytes").cast("string"))),
        F.lit("\r\n"),
    )


def write(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """pages: page_id, url, html. Writes folder/headers and folder/payloads."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    narrow = rows.select("page_id", "url", "sha256", F.octet_length("payload").cast("long").alias("_bytes"), sha1_base32(F.col("payload")).alias("_sha1"), F.monotonically_increasing_id().alias("_row"))
    narrow = staged(narrow, folder, "digests")
    rank = F.struct(F.col("page_id").isNull().alias("_late"), "page_id", "_row")
    first = staged(narrow.groupBy("sha256").agg(F.min(rank).alias("_first"), F.count(F.lit(1)).alias("copies")), folder, "first")
    stored = rows.groupBy("sha256").agg(F.first("payload").alias("payload"), F.count(F.lit(1)).alias("copies"))
    stored.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/payloads")
    joined = hot_join(narrow, first, "sha256", "copies", narrow.count())
    revisit = (F.col("_bytes") >= min_bytes) & (F.col("_row") != F.col("_first._row"))
    typed = joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumns({"refers_to": F.when(revisit, F.col("_first.page_id")), "_refers_row": F.when(revisit, F.col("_first._row"))})
    typed.select("page_id", header(date).alias("header"), "sha256", "copies").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/headers")


def read(spark: SparkSession, folder: str, salt_rows: int = 2_000) -> DataFrame:
    """The original records: page_id, header, payload (a revisit's is that of the record it refers to), its digest, record (the bytes of the whole record), and record_type, refers_to from the header."""
    salts = F.ceil(F.col("copies") / salt_rows).cast("int")
    heads = spark.read.schema(HEADERS).parquet(f"{folder}/headers").withColumn("_salt", F.pmod(F.xxhash64("page_id", "header"), salts.cast("long")).cast("int")).drop("copies")
    bad = F.raise_error(F.concat(F.lit("payload does not match its digest: "), F.col("sha256"))).cast("binary")
    stored = spark.read.schema(PAYLOADS).parquet(f"{folder}/payloads")
    stored = stored.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(bad))
    stored = stored.select("sha256", "payload", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    said = lambda name, value: F.regexp_extract("header", rf"\r\n{name}: {value}\r\n", 1)
    rows = heads.join(stored, ["sha256", "_salt"]).withColumns({"digest": sha1_base32(F.col("payload")), "record_type": said("WARC-Type", r"(\w+)")})
    block = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    whole = (said("WARC-Payload-Digest", r"sha1:(\w+)") == F.col("digest")) & (said("Content-Length", r"(\d+)") == F.octet_length(block).cast("string"))
    broken = F.raise_error(F.concat(F.lit("record does not match its header: "), F.col("header")))
    sound = lambda value, kind: F.when(whole, value).otherwise(broken.cast(kind))
    refers = said("WARC-Refers-To", r"<urn:page:(-?\d+):\d+>")
    return rows.select(
        "page_id",
        "header",
        sound(F.col("payload"), "binary").alias("payload"),
        sound(F.col("digest"), "string").alias("digest"),
        sound(F.concat(F.col("header").cast("binary"), block, F.lit("\r\n\r\n").cast("binary")), "binary").alias("record"),
        "record_type",
        F.when(refers != "", refers.cast("long")).alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS x,
             min(page_id) OVER (PARTITION BY b) AS first_id FROM p)
SELECT page_id, payload_bytes,
       translate(concat(
         lpad(upper(to_base(CAST(('0x' || substr(x, 1, 10)) AS BIGINT), 32)), 8, '0'),
         lpad(upper(to_base(CAST(('0x' || substr(x, 11, 10)) AS BIGINT), 32)), 8, '0'),
         lpad(upper(to_base(CAST(('0x' || substr(x, 21, 10)) AS BIGINT), 32)), 8, '0'),
         lpad(upper(to_base(CAST(('0x' || substr(x, 31, 10)) AS BIGINT), 32)), 8, '0')),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM h
"""
