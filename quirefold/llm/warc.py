"""Content-addressed WARC archive.

Two tables in the shared folder:

    payloads   key (SHA-256 of the payload), payload: each distinct payload once
    headers    page_id, key, head: the record's exact bytes up to the payload, and what follows

Records with equal payloads: the one with the largest page_id is the `response`, others are `revisit`
records that refer to it. A record is rebuilt by joining its header with its payload; the digest is
computed again from the rebuilt bytes and must be the one the header states. A payload shared by any share
of the pages is stored once, and both sides of the joins on its key are read from tables, so that
Spark splits it.

Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir
from .fingerprints import let
from .tables import stored, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(digest: Column) -> Column:
    """A digest of a multiple of 20 bits, from hexadecimal to upper-case base32."""
    letters = F.lit(BASE32)

    def group(at: Column) -> Column:
        value = F.conv(F.substr(digest, at * F.lit(5) + F.lit(1), F.lit(5)), 16, 10).cast("int")
        return F.concat(
            *(F.substr(letters, F.shiftright(value, by).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for by in (15, 10, 5, 0))
        )

    groups = F.sequence(F.lit(0), (F.length(digest) / F.lit(5)).cast("int") - F.lit(1))
    return F.array_join(F.transform(groups, group), "")


def sha1_base32(payload: Column) -> Column:
    return let(F.sha1(payload), base32_of_hex)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def lines(*fields: Column | str) -> Column:
    """Header lines; a null line is left out."""
    return F.concat(*(F.coalesce(F.concat(F.lit(f) if isinstance(f, str) else f, F.lit(CRLF)), F.lit("")) for f in fields))


def field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def record_head(row_type: Column, page_id: Column, url: Column, digest: Column, size: Column, refers_to: Column) -> Column:
    """WARC header, empty line, HTTP header, empty line. Line breaks in a url become spaces."""
    http = lines(
        "HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", field("Content-Length", size), ""
    )
    revisit = row_type == "revisit"
    target = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " ")
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(size)
    head = lines(
        "WARC/1.1",
        field("WARC-Type", row_type),
        field("WARC-Record-ID", record_id(page_id)),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", target),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(revisit, field("WARC-Profile", F.lit(PROFILE))),
        F.when(revisit, field("WARC-Refers-To", record_id(refers_to))),
        "Content-Type: application/http; msgtype=response",
        field("Content-Length", block),
        "",
    )
    return F.concat(head, http).cast("binary")


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Archive every page; payload: html in UTF-8, a null is an empty one.

    Payloads below ``least_bytes`` are never revisited. A null page_id is smaller than all others.
    Rows that repeat the largest page_id of a payload are all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    keyed = stored(
        rows.select(
            "page_id",
            "url",
            F.sha2("payload", 256).alias("key"),
            sha1_base32(F.col("payload")).alias("digest"),
            F.octet_length("payload").cast("bigint").alias("size"),
        ),
        "page-digests",
    )
    owners = stored(keyed.groupBy("key").agg(F.max("page_id").alias("owner")), "payload-owners")
    owned = keyed.join(owners, "key")
    is_owner = F.col("page_id").eqNullSafe(F.col("owner"))
    kind = F.when(is_owner | (F.col("size") < least_bytes), "response").otherwise("revisit")
    refers = F.when(kind == "revisit", F.col("owner"))
    head = record_head(kind, F.col("page_id"), F.col("url"), F.col("digest"), F.col("size"), refers)
    owned.select("page_id", "key", head.alias("head"), F.lit(CRLF + CRLF).cast("binary").alias("tail")).write.parquet(
        f"{folder}/headers"
    )
    distinct_payloads(rows, owners).write.parquet(f"{folder}/payloads")


def distinct_payloads(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """``key, payload`` of each owner, once.

    The owner's row brings the payload. Rows are dealt by payload and page id, which spreads a payload that many
    pages have; rows that repeat an owner lie together then, and are dropped where they lie.
    """
    keyed = rows.select(F.sha2("payload", 256).alias("key"), "page_id", "payload")
    named = owners.filter("owner is not null").withColumnRenamed("owner", "page_id")
    bearers = keyed.join(named.hint("merge"), ["key", "page_id"]).dropDuplicates(["key", "page_id"])
    nameless = keyed.filter("page_id is null").join(owners.filter("owner is null").select("key"), "key")
    return bearers.select("key", "payload").unionByName(nameless.select("key", "payload").dropDuplicates(["key"]))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, record_type, record``: the bytes of every record.

    A revisit's record has no payload; ``payload`` is then the one it refers to.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    joined = headers.join(spark.read.parquet(f"{folder}/payloads"), "key")
    text = F.col("head").cast("string")
    revisit = header_field(text, "WARC-Type") == "revisit"
    own = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    return joined.select(
        "page_id", F.col("head"), F.concat("head", own, "tail").alias("record"), "payload"
    )


def header_field(head: Column, name: str) -> Column:
    """The value of a header line, or null."""
    after = F.substring_index(head, f"{CRLF}{name}: ", -1)
    return F.when(F.locate(f"{CRLF}{name}: ", head) > 0, F.substring_index(after, CRLF, 1))


def describe_records(records: DataFrame) -> DataFrame:
    """What the records say, checked against their bytes. A digest that is wrong raises an error."""
    head = F.col("head").cast("string")
    stated = F.substring_index(header_field(head, "WARC-Payload-Digest"), "sha1:", -1)
    found = sha1_base32(F.col("payload"))
    refers = F.regexp_extract(F.coalesce(header_field(head, "WARC-Refers-To"), F.lit("")), "^<urn:page:(-?[0-9]+)>$", 1)
    block = header_field(head.substr(F.lit(1), F.locate(CRLF + CRLF, head) + 1), "Content-Length").cast("bigint")
    http = F.octet_length(head) - F.octet_length(F.substring_index(head, CRLF + CRLF, 1)) - 4
    kind = header_field(head, "WARC-Type")
    held = F.octet_length("record") - F.octet_length("head") - 4
    whole = (stated == found) & (block == http + held)
    return records.select(
        F.when(header_field(head, "WARC-Record-ID") == "<urn:page:>", None)
        .otherwise(F.regexp_extract(header_field(head, "WARC-Record-ID"), "^<urn:page:(-?[0-9]+)>$", 1).cast("bigint"))
        .alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(whole, stated).otherwise(F.raise_error(F.lit("a record does not match its digest or length"))).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(refers != "", refers.cast("bigint")).alias("refers_to"),
    )


def op7_content_addressed_archive(spark, sf_dir: str) -> DataFrame:
    folder = new_run_dir(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), folder)
    return describe_records(read_records(spark, folder))
