"""WARC records in a content-addressed archive.

The archive is two tables: ``payloads`` holds each distinct payload once,
under its SHA-256 (the address) with its SHA-1 in base32 (the label WARC
headers carry) and length; ``headers`` holds for every record the exact bytes
of its header block and the address of its payload. Reading back joins headers
to payloads, checks length and both digests of the stored bytes, and parses
the fields from the header bytes; ``full_records`` rebuilds the bytes of the
original records (a revisit record has no block of its own, its payload is
found through the join).

Of records with equal payloads the one with the largest page_id is the
response, the others are revisits that refer to it, down to payloads of
``min_bytes`` (0: empty payloads too); smaller ones are all responses.

Payload bytes are hashed where they are read; only (page_id, digest) pairs are
grouped, pre-aggregated on the map side, and only one copy of each payload
moves. The joins on the digest are plain shuffle joins, so Spark splits a
payload that a third of all pages share.

Defined cases: NULL html is the empty payload; NULL url gives an empty target
URI; control characters in a url are percent-encoded in the header; a NULL
page_id sorts lowest and is an empty record id; pages that repeat a page_id
and payload: one of them (the first written) is the response, the others
revisit it. An empty table gives an empty archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch

# The base32 alphabet and the header names of the WARC format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


@dataclass
class Archive:
    headers: DataFrame    # header binary, address string (SHA-256)
    payloads: DataFrame   # address string, digest string, bytes long, payload binary


def base32_of_hex(h: Column) -> Column:
    """Upper-case base32 of a hex string whose length is a multiple of 5
    (20 bits are five hex digits and four base32 digits)."""
    out = []
    for i in range(8):
        v = F.conv(F.substring(h, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(BASE32), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))


def write_archive(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                  key: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    """The two tables of the archive of ``pages``, in the shared folder."""
    scratch = Scratch(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    records = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    records = records.select("page_id", "url", "payload", F.sha2("payload", 256).alias("address"),
                             F.length("payload").cast("bigint").alias("bytes"))
    # narrow facts of every record, with a number that tells repeated rows apart
    facts = scratch.keep(records.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "address", "bytes",
                                        base32_of_hex(F.sha1("payload")).alias("digest"),
                                        F.monotonically_increasing_id().alias("row")))
    shared = F.col("bytes") >= min_bytes
    first = (facts.where(shared).groupBy("address")
                  .agg(F.max(F.struct("page_id", (-F.col("row")).alias("row"))).alias("first")))
    named = facts.join(first, "address", "left")
    is_first = F.col("first").isNull() | (F.col("first.row") == -F.col("row"))
    uri = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    record_id = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    lines = [F.lit(VERSION + EOL),
             _line("WARC-Type", F.when(is_first, "response").otherwise("revisit")),
             _line("WARC-Record-ID", record_id(F.col("page_id"))),
             _line("WARC-Date", F.lit(date)),
             _line("WARC-Target-URI", uri),
             _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
             F.when(is_first, F.lit("")).otherwise(F.concat(
                 _line("WARC-Refers-To", record_id(F.col("first.page_id"))),
                 _line("WARC-Profile", F.lit(REVISIT_PROFILE)))),
             _line("Content-Type", F.lit("text/html; charset=utf-8")),
             _line("Content-Length", F.when(is_first, F.col("bytes")).otherwise(0).cast("string")),
             F.lit(EOL)]
    headers = scratch.keep(named.select(F.encode(F.concat(*lines), "utf-8").alias("header"), "address"))
    # one copy of each payload: rows with the same address carry the same bytes
    payloads = scratch.keep(records.groupBy("address").agg(F.first("payload").alias("payload"))
                                   .select("address", base32_of_hex(F.sha1("payload")).alias("digest"),
                                           F.length("payload").cast("bigint").alias("bytes"), "payload"))
    return Archive(headers, payloads)


def field(header: Column, name: str) -> Column:
    """The value of a header line, NULL if there is none."""
    return F.nullif(F.regexp_extract(header, f"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def read_records(archive: Archive) -> DataFrame:
    """One row per record, joined to its payload: header, payload and what the
    header says. ``verified``: stored length and both digests agree with the
    stored bytes. The bytes are checked where they are stored: a reader that
    does not select ``payload`` moves digests and lengths only."""
    sound = ((F.sha2("payload", 256) == F.col("address")) & (base32_of_hex(F.sha1("payload")) == F.col("digest"))
             & (F.length("payload") == F.col("bytes")))
    stored = archive.payloads.select("address", "digest", "payload", sound.alias("sound"),
                                     F.length("payload").cast("bigint").alias("payload_bytes"))
    joined = archive.headers.join(stored, "address", "left")
    header = F.decode("header", "utf-8")
    page = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1)
    as_id = lambda c: F.when(c != "", c.cast("bigint"))
    return joined.select(
        "header", "payload", "address",
        as_id(page(field(header, "WARC-Record-ID"))).alias("page_id"),
        field(header, "WARC-Type").alias("record_type"),
        field(header, "WARC-Target-URI").alias("url"),
        F.regexp_extract(field(header, "WARC-Payload-Digest"), "sha1:(.*)", 1).alias("payload_digest"),
        as_id(page(field(header, "WARC-Refers-To"))).alias("refers_to"),
        "payload_bytes",
        F.coalesce(F.col("sound") & (F.col("digest") == F.regexp_extract(field(header, "WARC-Payload-Digest"),
                                                                         "sha1:(.*)", 1)), F.lit(False)).alias("verified"))


def full_records(archive: Archive) -> DataFrame:
    """page_id and ``record``: the bytes of the WARC record as first written
    (header block, block, two line ends; a revisit has an empty block)."""
    r = read_records(archive)
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "utf-8"))
    return r.select("page_id", F.concat("header", block, F.encode(F.lit(EOL + EOL), "utf-8")).alias("record"))


def open_archive(spark: SparkSession, headers_path: str, payloads_path: str) -> Archive:
    """An archive whose tables were saved under the two paths."""
    return Archive(spark.read.parquet(headers_path), spark.read.parquet(payloads_path))
