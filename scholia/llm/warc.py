"""Content-addressed web archive: payload bytes once per digest, exact record headers apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholia.llm.common import query, table
from scholia.session import cut_lineage, work_path

# The alphabet of base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
ROWS_A_TASK = 20_000  # records that one task puts together with one payload


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base 32 of 40 hexadecimal digits: each five of them are four characters."""
    letters = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def uri(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), row.cast("string"), F.lit(">"))


def lines(*pairs: tuple[str, Column]) -> Column:
    """``name: value`` lines; those without a value are left out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in pairs])


def one_line(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``path/headers`` (a row per record) and ``path/payloads`` (a row per distinct payload).

    Of equal payloads the record with the largest id (null last) is a response, the others revisit it;
    of rows repeated with one id, one is the response. A null payload or URL is empty; an empty table
    gives an empty archive; other columns are not read. Line ends in URLs are percent-encoded.
    """
    payload = F.encode(F.coalesce(pages[html_col], F.lit("")), "UTF-8")
    whole = pages.select(
        pages[id_col].cast("bigint").alias("page_id"), one_line(F.coalesce(pages[url_col], F.lit(""))).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    light = cut_lineage(whole.select(
        "page_id", "url", "digest", base32_of_hex(F.sha1("payload")).alias("sha1"), F.length("payload").cast("bigint").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"),
    ))
    first = F.max(F.struct("page_id", "row", "url"))
    chosen = cut_lineage(light.groupBy("digest").agg(first.alias("first")))
    rec = light.join(chosen, "digest").withColumn("is_first", F.col("row") == F.col("first.row"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF))
    rec = rec.withColumn("http", http)
    revisit = lambda c: F.when(~F.col("is_first"), c)
    block = F.length("http") + F.when(F.col("is_first"), F.col("n_bytes")).otherwise(0)
    head = F.concat(F.lit(f"WARC/1.1{CRLF}"), lines(
        ("WARC-Type", F.when(F.col("is_first"), F.lit("response")).otherwise("revisit")),
        ("WARC-Record-ID", uri(F.col("page_id"), F.col("row"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        ("WARC-Profile", revisit(F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", revisit(uri(F.col("first.page_id"), F.col("first.row")))),
        ("WARC-Refers-To-Target-URI", revisit(F.col("first.url"))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", block.cast("string")),
    ), F.lit(CRLF))
    rec.select("digest", head.alias("warc_head"), F.col("http").alias("http_head")).write.mode("overwrite").parquet(f"{path}/headers")
    # One copy a digest: copies meet within each task first, so a payload shared by many pages moves once a task.
    whole.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.mode("overwrite").parquet(f"{path}/payloads")


def field(name: str) -> Column:
    """A header field's value, null if the record hasn't any."""
    found = F.regexp_extract("warc_head", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.col("warc_head").contains(f"{CRLF}{name}: "), found)


def page_of(record: Column) -> Column:
    return F.regexp_extract(record, r"^<urn:page:(-?[0-9]+):", 1).try_cast("bigint")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``digest, payload``, each payload checked against its digest; a damaged one ends the job."""
    p = spark.read.parquet(f"{path}/payloads")
    fail = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    return p.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(fail.cast("binary")).alias("payload"))


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """The parsed fields next to the exact heads."""
    return spark.read.parquet(f"{path}/headers").select(
        "digest", "warc_head", "http_head", page_of(field("WARC-Record-ID")).alias("page_id"), field("WARC-Type").alias("record_type"),
        page_of(field("WARC-Refers-To")).alias("refers_to"), field("WARC-Target-URI").alias("url"),
        field("Content-Length").cast("bigint").alias("content_length"), field("WARC-Payload-Digest").alias("told_digest"),
    )


def read_records(spark: SparkSession, path: str, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """The original records: ``page_id, url, record_type, refers_to, record, head_bytes, payload``.

    ``record`` has the bytes as they stand in a WARC file (a revisit without its payload), the first ``head_bytes`` of
    them before the payload; ``payload`` is the page of responses and revisits alike. A record whose
    Content-Length or WARC-Payload-Digest isn't that of what was put together ends the job.

    Heads of a payload that more than ``rows_a_task`` records share are dealt over several tasks, each of which gets
    one copy of it.
    """
    h = read_headers(spark, path)
    shares = h.groupBy("digest").agg(F.ceil(F.count("*") / rows_a_task).alias("shares")).where("shares > 1")
    shares = cut_lineage(shares)  # empty, or few rows: of measured size for the joins
    share = F.pmod(F.xxhash64("warc_head"), F.coalesce("shares", F.lit(1)))
    h = h.join(shares, "digest", "left").withColumn("share", share).drop("shares")
    p = read_payloads(spark, path).join(shares, "digest", "left")
    p = p.select("digest", "payload", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("shares", F.lit(1)) - 1)).alias("share"))
    p = p.withColumn("payload_digest", base32_of_hex(F.sha1("payload")))
    r = h.join(p, ["digest", "share"])
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    block = F.concat(F.encode("http_head", "UTF-8"), body)
    sound = (F.col("content_length") == F.length(block)) & (F.col("told_digest") == F.concat(F.lit("sha1:"), "payload_digest"))
    fail = F.raise_error(F.concat(F.lit("damaged record "), F.col("warc_head"))).cast("binary")
    checked = lambda c: F.when(sound, c).otherwise(fail)
    record = F.concat(F.encode("warc_head", "UTF-8"), block, F.lit(b"\r\n\r\n"))
    return r.select(
        "page_id", "url", "record_type", "refers_to", checked(record).alias("record"),
        (F.octet_length("warc_head") + F.octet_length("http_head")).alias("head_bytes"), checked(F.col("payload")).alias("payload"),
    )


def archive_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per rebuilt record its type and reference, with length and digest of the payload: that inside a response, that restored to a revisit."""
    r = read_records(spark, path)
    inside = F.expr("substring(record, head_bytes + 1, length(record) - head_bytes - 4)")
    r = r.withColumn("body", F.when(F.col("record_type") == "response", inside).otherwise(F.col("payload")))
    return r.select(
        "page_id", F.length("body").cast("bigint").alias("payload_bytes"), base32_of_hex(F.sha1("body")).alias("payload_digest"), "record_type", "refers_to"
    )


def base32_sql(digest: str) -> str:
    part = "('0x' || substr({d}, {i}, 5))::BIGINT"
    out = []
    for i in range(1, 41, 5):
        v = part.format(d=digest, i=i)
        out += [f"substr('{BASE32}', (({v} >> {s}) & 31)::INTEGER + 1, 1)" for s in (15, 10, 5, 0)]
    return " || ".join(out)


SQL = f"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS s FROM pages
), r AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, {base32_sql('s')} AS payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS last
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM r
"""


@query("op5_warc", SQL)
def op5_warc(spark, sf_dir):
    path = work_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return archive_summary(spark, path)
