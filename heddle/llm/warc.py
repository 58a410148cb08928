"""A content-addressed web archive: payloads once, headers apart, records by join.

``write_archive`` stores each payload's bytes once, compressed, under its SHA-256,
and each record's exact header bytes in a second table; ``read_archive`` joins both
into the records' original bytes, and checks every payload against its digest.
``export_warc`` and ``import_warc`` turn records into WARC 1.1 files and back.
"""

import gzip
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.llm.batches import text_batches
from heddle.plans.durable import Scratch
from heddle.plans.joins import sent_if_small
from heddle.sources import table

#: Payloads of at least this many bytes are stored once; later ones revisit.
LEAST_BYTES = 0
#: Keys of rows without bytes of their own that are sent to the scan of pages; more are joined by a shuffle.
SENT_KEYS = 500_000
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The alphabet of RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(sha1_hex: Column) -> Column:
    """Base32 of 40 hexadecimal digits: ten digits are eight of base 32, each with its letter."""
    groups = [F.lpad(F.conv(F.substring(sha1_hex, at, 10), 16, 32), 8, "0") for at in range(1, 41, 10)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def packed(payload: Column) -> Column:
    """Payload bytes as a Zstandard frame: what is shuffled and stored is a fraction of the pages."""

    @F.pandas_udf("binary")
    def compress(payloads: pd.Series) -> pd.Series:
        return payloads.map(zstandard.ZstdCompressor(level=6).compress)

    return compress(payload)


def unpacked(frame: Column) -> Column:
    """The bytes of a frame, null where there is none or it is damaged."""

    @F.pandas_udf("binary")
    def decompress(frames: pd.Series) -> pd.Series:
        def one(data: bytes | None) -> bytes | None:
            try:
                return None if data is None else zstandard.ZstdDecompressor().decompress(data)
            except zstandard.ZstdError:
                return None

        return frames.map(one)

    return decompress(frame)


def _field(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _headers(date: str) -> Column:
    """The exact header bytes of a record: WARC fields, then those of the HTTP answer."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    revisit = F.col("record_type") == "revisit"
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("response_id").cast("string"), F.lit(">")))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"),
        _field("Content-Length", block.cast("string")),
        F.lit(CRLF),
        http,
    ).cast("binary")


def write_archive(pages: DataFrame, scratch: Scratch, least_bytes: int = LEAST_BYTES, date: str = "2026-01-01T00:00:00Z") -> tuple[DataFrame, DataFrame]:
    """Archive ``pages(page_id, url, html)``: the tables (headers, payloads) as written.

    A record per row. Null html is an empty payload, null urls leave out the
    target field. Of the rows with equal payloads of at least ``least_bytes``
    the largest page_id is the response and others revisit it; rows that repeat
    that page_id are responses too, over one stored payload. Rows with a null
    page_id are responses if no row of their payload has an id. Other columns
    are not read; an empty table gives empty tables.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.sha2(payload, 256).alias("digest")
    keyed = pages.select("page_id", "url", digest, base32(F.sha1(payload)).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    keyed = scratch.keep(keyed, "keyed")
    # how many rows repeat the response's page_id comes along, as only those need one picked
    counted = scratch.keep(keyed.groupBy("digest", "page_id").agg(F.count("*").alias("rows")), "counted")
    largest = counted.groupBy("digest").agg(F.max("page_id").alias("response_id"))
    first = F.col("page_id").eqNullSafe(F.col("response_id")) | (F.col("payload_bytes") < least_bytes)
    records = keyed.join(largest, "digest").withColumn("record_type", F.when(first, "response").otherwise("revisit"))
    headers = scratch.keep(records.select("digest", _headers(date).alias("header")), "headers")
    # the response's row brings the bytes; the keys of other rows, and of rows that repeat it, are told to the scan
    owner = F.col("page_id").eqNullSafe(F.col("response_id"))
    others = counted.join(largest, "digest").where(~owner | (F.col("rows") > 1))
    others = scratch.keep(others.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), owner.alias("_pick")), "others")
    told = sent_if_small(others, SENT_KEYS)
    stored = pages.select("page_id", digest, payload.alias("payload"))
    stored = stored.join(told, stored["page_id"].eqNullSafe(told["_id"]) & (stored["digest"] == told["_digest"]), "left").where("_pick is null or _pick")
    once = stored.where("_pick is null").select("digest", packed(F.col("payload")).alias("packed"))
    picked = stored.where("_pick").select("digest", packed(F.col("payload")).alias("packed")).dropDuplicates(["digest"])
    payloads = scratch.keep(once.unionByName(picked), "payloads")
    return headers, payloads


def read_archive(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """The records' original bytes with the full payload each stands for.

    Columns: ``header``, ``record`` (as a WARC file holds it, without the blank
    lines at its end) and ``payload``. A payload that doesn't match its digest,
    or a header without its payload, is an error.
    """
    joined = headers.join(payloads, "digest", "left").withColumn("payload", unpacked(F.col("packed")))
    sound = F.sha2("payload", 256).eqNullSafe(F.col("digest"))
    payload = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("archive: payload doesn't match its digest")).cast("binary"))
    own = F.when(header_field("WARC-Type", "header") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return joined.withColumn("payload", payload).select("header", F.concat("header", own).alias("record"), "payload")


def header_field(name: str, column: str = "record") -> Column:
    """A field of the record's own header block, null where it has none."""
    return field_of(name, F.substring_index(F.col(column).cast("string"), RECORD_END, 1))


def field_of(name: str, block: Column) -> Column:
    """A field's value in the lines of a header block: what stands behind its name, up to the line's end."""
    lines = F.concat(F.lit(CRLF), block)
    behind = F.substring_index(F.substring(lines, F.instr(lines, f"{CRLF}{name}: ") + len(CRLF) + len(name) + 2, F.length(lines)), CRLF, 1)
    return F.when(F.instr(lines, f"{CRLF}{name}: ") > 0, behind)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, "([0-9-]+)>$", 1).try_cast("long")


def describe_records(records: DataFrame) -> DataFrame:
    """What the archived records' bytes say, their lengths and digests checked anew.

    A record is its header block, its HTTP header and, for a response, the
    payload; the payload that a revisit stands for comes from the join. A block
    that isn't as long as its header says, or a payload whose digest isn't the
    header's, is an error.
    """
    # the two header blocks are cut out once, and only they are read as text
    block = F.substring_index(F.col("record").cast("string"), RECORD_END, 2)
    cut = records.select("record", "payload", block.alias("blocks"))
    cut = cut.select("record", "payload", F.octet_length("blocks").alias("length"), F.substring_index("blocks", RECORD_END, 1).alias("fields"))
    head = F.octet_length("fields") + len(RECORD_END)
    field = lambda name: field_of(name, F.col("fields"))
    parts = cut.select(
        page_of(field("WARC-Record-ID")).alias("page_id"),
        field("WARC-Type").alias("record_type"),
        page_of(field("WARC-Refers-To")).alias("refers_to"),
        F.substring(field("WARC-Payload-Digest"), F.lit(6), F.lit(32)).alias("told"),
        field("Content-Length").cast("long").alias("block_bytes"),
        (F.octet_length("record") - head).cast("long").alias("block_found"),
        F.when(field("WARC-Type") == "response", F.substring("record", F.col("length") + len(RECORD_END) + 1, F.octet_length("record"))).otherwise(F.col("payload")).alias("payload"),
    )
    sound = (F.col("block_bytes") == F.col("block_found")) & (base32(F.sha1("payload")) == F.col("told"))
    told = F.when(sound, F.col("told")).otherwise(F.raise_error(F.lit("archive: a record doesn't match its header")).cast("string"))
    return parts.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), told.alias("payload_digest"), "record_type", "refers_to")


def export_warc(records: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Write ``record`` bytes as gzipped WARC files, each record with its two line ends behind."""
    text = records.select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, record) of all records of the WARC files in ``path``, plain or gzipped.

    ``header`` ends after the HTTP header, as in ``read_archive``. Records are
    cut by their Content-Length, so payloads may hold anything.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                data, at, out = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data, 0, []
                while at < len(data):
                    body = data.index(b"\r\n\r\n", at) + 4
                    fields = dict(line.split(b": ", 1) for line in data[at:body].split(b"\r\n")[1:] if b": " in line)
                    end = body + int(fields[b"Content-Length"])
                    out.append((data[at : data.index(b"\r\n\r\n", body) + 4], data[at:end]))
                    at = end + 4
                yield pd.DataFrame(out, columns=["header", "record"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc,txt}").load(path)
    return files.select("content").mapInPandas(records, "header binary, record binary")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archive back and describe its records."""
    text_batches(spark)
    scratch = Scratch(spark, "warc")
    return describe_records(read_archive(*write_archive(table(spark, sf_dir, "pages"), scratch)))


def warc_repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over all pages and a second crawl of them, so that half of the records are revisits."""
    text_batches(spark)
    pages = table(spark, sf_dir, "pages")
    again = pages.withColumn("page_id", -1 - F.col("page_id"))
    return describe_records(read_archive(*write_archive(pages.unionByName(again), Scratch(spark, "warc"))))


def _sql(pages: str) -> str:
    return f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM {pages}),
        k AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS response FROM p)
        SELECT page_id, payload_bytes,
            list_aggregate(list_transform(range(0, 32), lambda k: substr('{BASE32}',
                CAST(((CAST('0x' || substr(h, CAST(k // 8 * 10 + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
            CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response THEN response END AS refers_to
        FROM k"""


QUERIES = {"op10_warc": op10_warc, "warc_repeated_pages": warc_repeated_pages}
ORACLE_SQL = {"op10_warc": _sql("pages"), "warc_repeated_pages": _sql("(SELECT page_id, html FROM pages UNION ALL SELECT -1 - page_id, html FROM pages)")}
