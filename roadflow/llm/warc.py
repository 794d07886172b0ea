"""Content-addressed WARC archive.

An archive is two Parquet tables below one folder:

``payloads``  one row per distinct payload: its SHA-256 (the address), SHA-1, length and bytes, in buckets by
              address and the id of the page that holds it.
``records``   one row per page: the exact header block of its WARC record (WARC/1.1, CRLF line ends), the
              address of its payload and, for readers that want it, the page id and URL.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the largest page id is a
``response`` record and the others are ``revisit`` records that refer to it; smaller payloads are always
responses. A response's block is the payload, a revisit's block is empty; either way the payload is stored
once. Reading joins records to payloads, checks every payload against both digests and gives back the exact
record bytes. A large payload has one response, which meets it in its bucket, so the bytes are not moved again;
small payloads, which may have very many responses, are joined by address. The length and digest of a response are
taken from its rebuilt record, those of a revisit from the payload it refers to. Equality is equality of SHA-256 and length; the bytes themselves are never a shuffle key, and
a payload with a million pages is one row of ``payloads`` and an aggregate of ids before the shuffle.

Very long payloads: a record is one value and so below 2 GB. Other columns of ``pages`` are not read. An empty table
gives an empty archive. Defined results: a null payload is empty; a null page id sorts before every number and is written as
``null``; repeated rows with the largest id are all responses; a page whose URL is null has no target URI.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.session import path_exists, read_text, scratch_path, write_text

REVISIT_BYTES = 1000
#: Fixed value: the profile URI that the WARC standard gives for identical payloads.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends inside the value become spaces."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit(CRLF)), F.lit(""))


def _held(address: Column, page_id: Column) -> Column:
    """Names a payload by its address and the page that holds it."""
    return F.concat_ws(":", F.hex(address), F.coalesce(page_id.cast("string"), F.lit("null")))


def _table(path: str) -> str:
    """A session's name for the payloads of an archive."""
    return f"warc_{md5(path.encode()).hexdigest()}"


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payload table, with its buckets known to the planner where the archive says how many."""
    if not path_exists(spark, f"{path}/buckets"):
        return spark.read.parquet(f"{path}/payloads")
    if not spark.catalog.tableExists(_table(path)):
        spark.sql(
            f"create table {_table(path)} (held string, address binary, sha1 string, bytes bigint, payload binary) using parquet "
            f"clustered by (held) into {int(read_text(spark, f'{path}/buckets'))} buckets location '{path}/payloads'"
        )
    return spark.table(_table(path))


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the archive of ``pages`` (page_id, url, html) below ``path``. ``date`` is the capture date."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    body = pages.select("page_id", "url", payload.alias("payload"))
    digests = body.select("page_id", "url", F.unhex(F.sha2("payload", 256)).alias("address"), F.sha1("payload").alias("sha1"), F.length("payload").cast("long").alias("bytes"))
    newest = digests.groupBy("address").agg(F.max("page_id").alias("newest"), F.min("sha1").alias("sha1"), F.min("bytes").alias("bytes"))

    # one holder of each payload, the row with the newest id; join, aggregate and buckets share one key, so that
    # bytes move once, and a group of the aggregate is repeated rows with one id
    chosen = newest.select(_held(F.col("address"), F.col("newest")).alias("held"), "address", "sha1", "bytes")
    named = body.select(_held(F.unhex(F.sha2("payload", 256)), F.col("page_id")).alias("held"), "payload")
    holders = named.join(chosen, "held").groupBy("held").agg(*[F.first(c).alias(c) for c in ("address", "sha1", "bytes", "payload")])
    buckets = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # those of the aggregate
    w = holders.write.bucketBy(buckets, "held").option("path", f"{path}/payloads").option("compression", "zstd")
    w.saveAsTable(_table(path))
    write_text(pages.sparkSession, f"{path}/buckets", str(buckets))

    joined = digests.select("page_id", "url", "address").join(newest, "address")
    revisit = (F.col("bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("newest"))
    only_revisit = lambda c: F.when(revisit, c)
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Refers-To", only_revisit(_record_id(F.col("newest")))),
        _line("WARC-Profile", only_revisit(F.lit(REVISIT_PROFILE))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes"))),
        F.lit(CRLF),
    )
    joined.select("page_id", "url", "address", header.alias("header")).write.parquet(f"{path}/records")


def _field(name: str) -> Column:
    """The value of a header line, null without it."""
    got = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(got != "", got)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: header fields, full payload, its length as stored, and ``record``, the exact bytes
    of the record.

    Fails on a payload that does not have the digests it is stored under. Columns not asked for are not made.
    """
    payloads = _payloads(spark, path)
    sound = (F.unhex(F.sha2("payload", 256)) == F.col("address")) & (F.sha1("payload") == F.col("sha1"))
    checked = lambda value: F.when(sound, value).otherwise(F.raise_error(F.lit("payload does not have its digest")))
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("null")).cast("long")
    fields = spark.read.parquet(f"{path}/records").select(
        "header",
        "address",
        page(_field("WARC-Record-ID")).alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        page(_field("WARC-Refers-To")).alias("refers_to"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("header_digest"),
        _field("Content-Length").cast("long").alias("content_length"),
    )
    response, large = F.col("record_type") == "response", F.col("content_length") >= REVISIT_BYTES
    end = f"{CRLF}{CRLF}".encode()
    head = F.encode("header", "UTF-8")

    # responses: the record is put together, and what is said of its payload is read from it
    by_holder = payloads.where(F.col("bytes") >= REVISIT_BYTES).select("held", checked(F.col("payload")).alias("payload"))
    by_address = payloads.where(F.col("bytes") < REVISIT_BYTES).select("address", checked(F.col("payload")).alias("payload"))
    one_each = fields.where(response & large).withColumn("held", _held(F.col("address"), F.col("page_id"))).join(by_holder, "held").drop("held")
    many_each = fields.where(response & ~large).join(by_address, "address").select(*one_each.columns)
    built = one_each.unionByName(many_each).withColumn("record", F.concat(head, F.col("payload"), F.lit(end)))
    block = F.substring("record", F.octet_length(head) + 1, F.octet_length("record") - F.octet_length(head) - len(end))
    responses = built.withColumn("payload_bytes", F.octet_length(block).cast("long")).withColumn("payload_digest", F.sha1(block))

    # revisits have no block; each column of the payload carries the check, so that lengths move without the bytes
    whole = payloads.where(F.col("bytes") >= REVISIT_BYTES).select(
        "address", *[checked(c).alias(n) for n, c in (("payload", F.col("payload")), ("payload_bytes", F.octet_length("payload").cast("long")), ("payload_digest", F.sha1("payload")))]
    )
    revisits = fields.where(~response).join(whole, "address").withColumn("record", F.concat(head, F.lit(end)))
    found = responses.unionByName(revisits)
    same = F.col("payload_digest") == F.col("header_digest")
    told = F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("record does not have the digest of its header")))
    return found.withColumn("payload_digest", told).drop("header_digest")


def archived(pages: DataFrame) -> DataFrame:
    """``pages`` written to a new archive in the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
