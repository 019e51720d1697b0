"""A content-addressed web archive: payload bytes once by digest, exact record headers apart, records by joins.

An archive is a folder with two tables.  ``blobs`` holds every payload once
under its SHA-256.  ``records`` holds of every record the exact bytes before
the payload (WARC header and, if any, the header of the transfer protocol), the
bytes after it, and the digest of the payload, null for records without one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortloom.llm.batches import FREE_SHUFFLES, settings
from cohortloom.llm.registry import query, table
from cohortloom.session import saved, scratch_path

BREAK = "\r\n"
END = BREAK * 2  # of a header, and after a record
# fixed values of the archive format and of the digests' alphabet
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE_32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE_32_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FILE_BYTES = 128 * 2**20  # of an archive file that is read
DATE = "2000-01-01T00:00:00Z"  # of the records made here, unless one is given


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 as 32 upper-case letters and digits: five hexadecimal digits make four."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), BASE_32_DIGITS, BASE_32_LETTERS)


def _bytes(*parts: Column | str) -> Column:
    return F.concat(*[(F.lit(p) if isinstance(p, str) else p).cast("binary") for p in parts])


def _required(condition: Column, message: str, value: Column) -> Column:
    """The value, where the condition holds; else the job fails with the message."""
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.raise_error(F.lit(message)).cast("binary"))


def _store_payloads(rows: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, payload, digest) as the blobs of a new archive; returns digest, owner, bytes and sha1 of each.

    The owner is the largest page_id.  The window is limited before its
    shuffle, so that one copy of a payload leaves each task at most: a payload
    in a third of all rows is no hot key.
    """
    spark = rows.sparkSession
    first = Window.partitionBy("digest").orderBy(F.col("page_id").desc_nulls_last())
    kept = rows.filter("payload IS NOT NULL").select("digest", "page_id", "payload").withColumn("_row", F.row_number().over(first)).filter("_row = 1")
    with settings(spark, FREE_SHUFFLES):
        kept.select(
            "digest", F.col("page_id").alias("owner"), F.length("payload").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1"), "payload"
        ).write.parquet(f"{folder}/blobs")
    return spark.read.parquet(f"{folder}/blobs").select("digest", "owner", "bytes", "sha1")


def store_pages(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Write (page_id, url, payload) as one record each into an archive in a new folder.

    Of pages with equal payloads of at least ``least_bytes`` the one with the
    largest page_id is a response record and the others revisit it; smaller
    payloads are response records that share the stored bytes.  Equal digests
    with different lengths or second digests fail the job, as then the digest
    names no single payload.

    A null payload is empty.  A null url has no target line; control characters
    of a url are percent-encoded.  A null page_id is the smallest.  Pages that
    share the largest page_id of a payload are all response records.  An empty
    table makes an empty archive.  Other columns do not matter.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    owners = _store_payloads(rows, folder)
    thin = rows.select("digest", "page_id", "url", F.length("payload").alias("_bytes"), base32_sha1(F.col("payload")).alias("_sha1"))
    sound = (F.col("_bytes") == F.col("bytes")) & (F.col("_sha1") == F.col("sha1"))
    known = thin.join(owners, "digest").withColumn("_again", (F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("owner")))
    with settings(pages.sparkSession, FREE_SHUFFLES):
        known.select(
            "page_id", F.when(~F.col("_again"), F.col("digest")).alias("digest"),
            _required(sound, "two payloads have one digest", _head(F.col("_again"), date)).alias("head"), F.lit(END.encode()).alias("tail"),
        ).write.parquet(f"{folder}/records")


def store_records(records: DataFrame, folder: str) -> None:
    """Write records (page_id, head, payload, tail), as ``split_files`` gives them, into an archive in a new folder.

    Heads and tails are kept byte by byte; a null payload stays absent.
    """
    rows = records.select("page_id", "head", "payload", "tail").withColumn("digest", F.sha2("payload", 256))
    _store_payloads(rows, folder)
    with settings(records.sparkSession, FREE_SHUFFLES):
        rows.select("page_id", "digest", "head", "tail").write.parquet(f"{folder}/records")


def _record_id(page: Column) -> Column:
    """A name made from page and payload, as a URN."""
    h = F.md5(_bytes(F.coalesce(page.cast("string"), F.lit("")), ":", F.col("digest")))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _head(again: Column, date: str) -> Column:
    """The exact bytes before the payload."""
    safe = F.replace(F.replace(F.regexp_replace("url", r"[\x00-\x09\x0B\x0C\x0E-\x1F\x7F]", "%20"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(again, 0).otherwise(F.col("bytes"))

    def line(name: str, value: Column | str) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit(BREAK)), F.lit(""))

    return _bytes(
        f"WARC/1.1{BREAK}", line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))), line("WARC-Date", date), line("WARC-Target-URI", safe),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(again, F.concat(line("WARC-Profile", SAME_PAYLOAD), line("WARC-Refers-To", _record_id(F.col("owner"))))).otherwise(""),
        line("X-Page-ID", F.col("page_id").cast("string")),
        line("Content-Type", "application/http; msgtype=response"), line("Content-Length", length.cast("string")), BREAK, http,
    )


def restore(spark: SparkSession, folder: str, tails: bool = True) -> DataFrame:
    """(page_id, record) of an archive: the bytes of every record with its tail, as they were.

    Records without a payload are not joined.  A payload that does not have the
    digest it is stored under, or is absent, fails the job.
    """
    blobs, records = spark.read.parquet(f"{folder}/blobs"), spark.read.parquet(f"{folder}/records")
    verified = blobs.select("digest", _required(F.sha2("payload", 256) == F.col("digest"), "a payload does not have its digest", F.col("payload")).alias("payload"))
    end = F.col("tail") if tails else F.lit(b"")
    full = records.filter("digest IS NOT NULL").join(verified, "digest", "left")
    whole = _required(F.col("payload").isNotNull(), "a payload is not in the archive", F.concat("head", "payload", end))
    bare = records.filter("digest IS NULL").select("page_id", F.concat("head", end).alias("record"))
    return full.select("page_id", whole.alias("record")).unionByName(bare)


def write_files(spark: SparkSession, folder: str, path: str) -> None:
    """Write the restored records of an archive as plain archive files, by Spark's own writer, in no fixed order.

    Every record ends with the two line breaks the format asks for, whatever
    its stored tail.
    """
    body = restore(spark, folder, tails=False).select(F.col("record").cast("string"))
    body.write.option("lineSep", END).text(path)


def _split(content: bytes) -> Iterator[tuple[int, bytes, bytes | None, bytes]]:
    """(offset, head, payload, tail) of the records of a file; raises ValueError where there is none."""
    at = 0
    while at < len(content):
        end = content.find(END.encode(), at)
        size = re.search(rb"(?im)^Content-Length:[ \t]*(\d+)", content[at:end]) if end >= 0 else None
        if not content.startswith(b"WARC/", at) or size is None:
            raise ValueError(f"no record at byte {at}")
        header, block = content[at : end + len(END)], end + len(END)
        stop = block + int(size[1])
        if stop > len(content):
            raise ValueError(f"the record at byte {at} is cut off")
        inner = block
        if re.search(rb"(?im)^Content-Type:[ \t]*application/http", header) and (found := content.find(END.encode(), block, stop)) >= 0:
            inner = found + len(END)
        again = re.search(rb"(?im)^WARC-Type:[ \t]*revisit", header)
        after = stop
        while content[after : after + 2] == BREAK.encode():
            after += 2
        yield at, content[at:inner if not again else stop], None if again else content[inner:stop], content[stop:after]
        at = after


def split_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, page_id, head, payload, tail) of the records of plain archive files; page_id is the record's first byte.

    A file is read in one piece, so files over ``FILE_BYTES`` fail the job, as
    do files that are not whole records.  An empty file has no records.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "page_id", "head", "payload", "tail"]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                for record in _split(content.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((file.as_py(), *record), kinds, strict=True)], names)

    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    files = spark.read.format("binaryFile").load(path)
    content = _required(F.col("length") <= FILE_BYTES, "an archive file is too large", F.col("content"))
    return files.select("path", content.alias("content")).mapInArrow(split, "file string, page_id bigint, head binary, payload binary, tail binary")


def parse(records: DataFrame, column: str = "record") -> DataFrame:
    """Add type, record_id, page_id, refers_to, digest and payload, as the bytes of a record tell them.

    A field that the header does not have is null; names of fields are found in
    any case.  The payload is what follows the header of the transfer protocol
    in the block, if one is declared, else the block; null for a revisit.
    Columns of these names are replaced, others stay.
    """
    text = F.col(column).cast("string")

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("_head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))

    cut = records.withColumn("_head", F.substring_index(text, END, 1)).withColumn("_start", F.octet_length("_head") + len(END))
    block = cut.withColumn("_block", F.substring(F.col(column).cast("binary"), F.col("_start") + 1, field("Content-Length").cast("int")))
    inner = F.octet_length(F.substring_index(F.col("_block").cast("string"), END, 1)) + len(END)
    payload = F.when(field("Content-Type").startswith("application/http"), F.substring("_block", inner + 1, F.length("_block"))).otherwise(F.col("_block"))
    return block.withColumns({
        "type": field("WARC-Type"), "record_id": field("WARC-Record-ID"), "page_id": field("X-Page-ID").cast("bigint"),
        "refers_to": field("WARC-Refers-To"), "digest": F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""),
        "payload": F.when(field("WARC-Type") != "revisit", payload),
    }).drop("_head", "_start", "_block")


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, read from the restored bytes: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest are computed from the restored payload, for a revisit
    from that of the record it refers to; a header that names another digest,
    or a revisit of no record, fails the job.
    """
    facts = parse(restore(spark, folder)).select(
        "page_id", "type", "record_id", "refers_to", "digest", F.length("payload").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1")
    )
    facts = saved(facts)
    answers, again = facts.filter("type <> 'revisit'"), facts.filter("type = 'revisit'").drop("bytes", "sha1")
    named = answers.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.max("page_id").alias("target"), F.max("bytes").alias("bytes"), F.max("sha1").alias("sha1")
    )
    wanted = ["page_id", "bytes", "sha1", "digest", "type", "target"]
    rows = answers.withColumn("target", F.lit(None).cast("bigint")).select(wanted).unionByName(again.join(named, "refers_to", "left").select(wanted))
    sound = _required(F.col("sha1") == F.col("digest"), "a payload does not have the digest of its record's header", F.col("sha1"))
    return rows.select(
        "page_id", F.col("bytes").cast("bigint").alias("payload_bytes"), sound.cast("string").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("target").alias("refers_to"),
    )


@query(
    "op12_warc_archive",
    """WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
       d AS (SELECT *, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS owner FROM p),
       v AS (SELECT *, list_transform(range(8), lambda g: ('0x' || substr(h, (5 * g + 1)::INT, 5))::INT) AS fives FROM d)
       SELECT page_id, n AS payload_bytes,
              array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((fives[1 + i // 4] >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
              CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
              CASE WHEN page_id <> owner THEN owner END AS refers_to FROM v""",
)
def op12_warc_archive(spark, sf):
    folder = scratch_path(spark, "archive")
    store_pages(table(spark, sf, "pages").select("page_id", "url", F.col("html").alias("payload")), folder)
    return read_back(spark, folder)
