"""Legacy archives to WARC: ARC files are parsed by their version's header lines and declared lengths
and rewritten as WARC records with identifiers, timestamps, types and digests.

Archives are written and read through Spark's own file sources (``text`` and ``binaryFile``), so they
can live in any store that Spark reaches. Each archive holds about ``archive_bytes`` of records, which
bounds what one task has to hold; a larger single record gets an archive of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_BYTES = 8_000_000
#: What a task hands on at a time.
CHUNK_BYTES = 4_000_000

# The field names that stand in the version block of an ARC file, by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ],
}
# WARC names.
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"

RECORD = (
    "archive string, offset long, version int, url string, ip string, date string, content_type string, "
    "status string, checksum string, block binary"
)
WARC_RECORD = (
    "type string, record_id string, target_uri string, date string, content_type string, "
    "block_digest string, payload_digest string, payload_bytes long, refers_to string, "
    "page_id long, refers_to_page long, block binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def gunzip(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def in_chunks(rows: Iterable[tuple], names: list[str], measure: int) -> Iterator[pd.DataFrame]:
    """Frames of at most about ``CHUNK_BYTES``, by the length of field ``measure``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[measure] or b"") + 200
        if size >= CHUNK_BYTES:
            yield pd.DataFrame(held, columns=names, dtype=object)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names, dtype=object)


def names_of(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(",")]


# --- writing ---------------------------------------------------------------------------------------


def write_archives(
    records: DataFrame, path: str, separator: str, archive_bytes: int = ARCHIVE_BYTES, opening: bytes = b""
) -> None:
    """Gzipped text files of the binary ``record``s, each followed by ``separator``; bytes are written as they are.

    Archives are filled in the order of the rows of a task; ``opening`` stands at the start of each.
    """

    def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, archive, place, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            rows = []
            for record in batch["record"]:
                if size and size + len(record) > archive_bytes:
                    archive, place, size = archive + 1, 0, 0
                size += len(record)
                rows.append((f"{task:05d}-{archive:05d}", place, record if place else opening + record))
                place += 1
            yield pd.DataFrame(rows, columns=["archive", "place", "record"])

    (
        records.select("record")
        .mapInPandas(roll, "archive string, place long, record binary")
        .sortWithinPartitions("archive", "place")
        .select(F.col("record").cast("string").alias("value"), "archive")
        .write.partitionBy("archive")
        .option("lineSep", separator)
        .option("compression", "gzip")
        .text(path)
    )


def arc_records(pages: DataFrame, id_column: str, url_column: str, html_column: str, date: str) -> DataFrame:
    """ARC records of captured pages, version 1 for even ids and version 2 for odd ones.

    The captured document is an HTTP answer whose ``X-Page-Id`` header carries the id (absent if null)
    and whose body is the page in UTF-8 (null: empty). Blanks in an address are percent-encoded, a null
    or empty address is written as ``-``.
    """
    url = F.regexp_replace(F.coalesce(F.col(url_column).cast("string"), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    body = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    page = F.col(id_column).cast("string")
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}"),
        F.coalesce(F.concat(F.lit("X-Page-Id: "), page, F.lit(CRLF)), F.lit("")),
        F.lit(CRLF),
    )
    length = (F.octet_length("document")).cast("string")
    first = F.concat_ws(" ", F.col("url"), F.lit("0.0.0.0"), F.lit(date), F.lit("text/html"))
    second = F.concat_ws(" ", F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc"))
    return (
        pages.select(
            F.when(url == "", "-").otherwise(url).alias("url"),
            F.concat(head, body).alias("document"),
            (F.pmod(F.coalesce(F.col(id_column).cast("long"), F.lit(0)), F.lit(2)) + 1).alias("version"),
        )
        .select(
            "version",
            F.concat(
                F.when(F.col("version") == 1, first).otherwise(F.concat_ws(" ", first, second)),
                F.lit(" "),
                length,
                F.lit("\n"),
                F.col("document"),
            )
            .cast("binary")
            .alias("record"),
        )
    )


def version_block(version: int, date: str) -> bytes:
    """The record that opens an ARC file and names the fields of the others."""
    body = f"{version} 0 -\n{' '.join(ARC_FIELDS[version])}\n".encode()
    extra = " 200 - - 0 pages.arc" if version == 2 else ""
    return f"filedesc://pages.arc 0.0.0.0 {date} text/plain{extra} {len(body)}\n".encode() + body


def write_arc(records: DataFrame, path: str, version: int, date: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """ARC files of one version from binary ``record``s; every file opens with its version block."""
    write_archives(records, path, "\n", archive_bytes, version_block(version, date) + b"\n")


# --- the converter ---------------------------------------------------------------------------------


def parse_arc(data: bytes, archive: str) -> Iterator[tuple]:
    """The records of an ARC file. The version block says which fields the header lines have.

    Records are cut by their declared length only; what they contain is not looked at. Line ends
    between records are skipped. A header line with another number of fields, a length that is no
    number or that runs past the end raises, since everything after it would be guesswork.
    """
    at, fields, version = 0, ARC_FIELDS[1], 1
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if data.startswith(b"filedesc://", at):
            # the version block's own line has the fields of the version that it declares
            fields = ARC_FIELDS[2] if len(values) == len(ARC_FIELDS[2]) else ARC_FIELDS[1]
        if end < 0 or len(values) != len(fields) or not values[-1].isdigit() or end + 1 + int(values[-1]) > len(data):
            raise ValueError(f"{archive}: no header line of version {version} at byte {at}")
        header, block = dict(zip(fields, values)), data[end + 1 : end + 1 + int(values[-1])]
        if header["URL"].startswith("filedesc://"):
            version = int(block.split(b" ", 1)[0])
            fields = block.split(b"\n")[1].decode().strip().split(" ")
        yield (
            archive,
            at,
            version,
            header["URL"],
            header["IP-address"],
            header["Archive-date"],
            header["Content-type"],
            header.get("Result-code"),
            header.get("Checksum"),
            block,
        )
        at = end + 1 + len(block)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the ARC files below ``path``, version blocks included, plain or gzipped."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                yield from in_chunks(parse_arc(gunzip(content), name), names_of(RECORD), 9)

    return archive_files(spark, path).mapInPandas(parse, RECORD)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the archives below ``path``; no rows if there are none."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )


def w3c_time(date: str) -> str:
    """ARC's 14 digits (shorter ones are filled up) as a WARC timestamp."""
    digits = (re.sub(r"[^0-9]", "", date) + "00000101000000"[len(re.sub(r"[^0-9]", "", date)) :])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def payload_of(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (blank line included) and body."""
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def warc_fields(url: str, date: str, content_type: str, block: bytes) -> tuple:
    """The WARC record of an ARC record, before duplicates are marked.

    Version blocks become ``warcinfo``, HTTP answers ``response``, all else ``resource``. The identifier
    is a UUID derived from type, address, date, page id and payload digest, so that a repeated conversion
    gives the same. ``page_id`` is read from the captured ``X-Page-Id`` header (null if absent).
    """
    is_http = block.startswith(b"HTTP/")
    head, body = payload_of(block) if is_http else (b"", block)
    kind = "warcinfo" if url.startswith("filedesc://") else "response" if is_http else "resource"
    page = re.search(rb"(?mi)^X-Page-Id: (-?\d+)\r?$", head)
    digest, time = base32_sha1(body), w3c_time(date)
    seed = f"{kind} {url} {time} {page and page[1].decode()} {digest}"
    return (
        kind,
        f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>",
        url,
        time,
        "application/http; msgtype=response" if is_http else content_type,
        base32_sha1(block),
        digest,
        len(body),
        None,
        int(page[1]) if page else None,
        None,
        block,
    )


def convert_arc(spark: SparkSession, path: str, with_blocks: bool = True) -> DataFrame:
    """The ARC files below ``path`` as WARC records; without their blocks if only the fields are of use."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for name, content in zip(batch["path"], batch["content"]):
                    for _, _, _, url, _, date, content_type, _, _, block in parse_arc(gunzip(content), name):
                        fields = warc_fields(url, date, content_type, block)
                        yield fields if with_blocks else (*fields[:-1], None)

        yield from in_chunks(records(), names_of(WARC_RECORD), 11)

    return archive_files(spark, path).mapInPandas(convert, WARC_RECORD)


def first_responses(fields: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, first): the smallest page id, with its record, of payloads that several responses have.

    The digest is a struct, which is shuffled anew for a join, so that Spark can split a hot payload.
    """
    return (
        fields.where(eligible(min_bytes))
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id"))).alias("first"),
            F.count("*").alias("copies"),
        )
        .where((F.col("copies") > 1) & F.col("first").isNotNull())
        .select(F.struct("digest").alias("digest"), "first")
    )


def eligible(min_bytes: int) -> Column:
    return (F.col("type") == "response") & (F.col("payload_bytes") >= min_bytes)


def mark_revisits(records: DataFrame, first: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Responses whose payload another response has too become revisits of the one with the smallest page id.

    Payloads under ``min_bytes`` are left. The blocks of revisits keep the HTTP head alone. Records with the
    smallest id itself (repeated rows) all stay responses, as do records if no id is known.
    """
    is_copy = eligible(min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    head = F.expr("substring(block, 1, length(block) - payload_bytes)")
    return (
        records.join(first, F.struct("payload_digest") == F.col("digest"), "left")
        .withColumn("revisit", F.coalesce(is_copy, F.lit(False)))
        .select(
            F.when(F.col("revisit"), "revisit").otherwise(F.col("type")).alias("type"),
            "record_id",
            "target_uri",
            "date",
            "content_type",
            "block_digest",
            "payload_digest",
            "payload_bytes",
            F.when(F.col("revisit"), F.col("first.record_id")).alias("refers_to"),
            "page_id",
            F.when(F.col("revisit"), F.col("first.page_id")).alias("refers_to_page"),
            F.when(F.col("revisit"), head).otherwise(F.col("block")).alias("block"),
        )
    )


# --- WARC files ------------------------------------------------------------------------------------


def write_warc(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Gzipped WARC files; ``X-Page-Id``, ``X-Payload-Length`` and ``X-Refers-To-Page-Id`` are extension fields."""

    def line(name: str, column: str) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit(CRLF)), F.lit(""))

    revisit = F.col("type") == "revisit"
    head = F.concat(
        F.lit(f"{WARC_VERSION}{CRLF}"),
        line("WARC-Type", "type"),
        line("WARC-Record-ID", "record_id"),
        line("WARC-Date", "date"),
        line("WARC-Target-URI", "target_uri"),
        line("WARC-Refers-To", "refers_to"),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}")).otherwise(F.lit("")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit(CRLF)),
        # the digest of a shortened block is not the converter's; readers do without it
        F.when(revisit, F.lit("")).otherwise(
            F.concat(F.lit("WARC-Block-Digest: sha1:"), F.col("block_digest"), F.lit(CRLF))
        ),
        line("Content-Type", "content_type"),
        line("X-Page-Id", "page_id"),
        line("X-Payload-Length", "payload_bytes"),
        line("X-Refers-To-Page-Id", "refers_to_page"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(CRLF + CRLF)),
    )
    record = F.concat(head.cast("binary"), F.col("block")).alias("record")
    write_archives(records.select(record), path, CRLF + CRLF, archive_bytes)


def parse_warc(data: bytes) -> Iterator[tuple]:
    """The records of a WARC file, cut by Content-Length; a record without one raises."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for field in data[at:end].decode("utf-8", "replace").split(CRLF)[1:]:
            name, _, value = field.partition(": ")
            fields[name.lower()] = value
        size = int(fields["content-length"])
        number = {n: int(fields[n]) if n in fields else None for n in ("x-page-id", "x-refers-to-page-id")}
        yield (
            fields["warc-type"],
            fields.get("warc-record-id"),
            fields.get("warc-target-uri"),
            fields.get("warc-date"),
            fields.get("content-type"),
            fields.get("warc-block-digest", "").removeprefix("sha1:") or None,
            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            int(fields["x-payload-length"]),
            fields.get("warc-refers-to"),
            number["x-page-id"],
            number["x-refers-to-page-id"],
            data[end + 4 : end + 4 + size],
        )
        at = end + 4 + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the WARC files below ``path``, plain or gzipped."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                yield from in_chunks(parse_warc(gunzip(content)), names_of(WARC_RECORD), 11)

    return archive_files(spark, path).mapInPandas(parse, WARC_RECORD)


def archive_pages(
    pages: DataFrame,
    path: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    date: str = "20240101000000",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Pages into legacy archives of both versions, these into WARC files, and the WARC files' records.

    An empty table gives no rows. Extra columns of ``pages`` are not archived.
    """
    spark = pages.sparkSession
    records = arc_records(pages, id_column, url_column, html_column, date)
    for version in ARC_FIELDS:
        write_arc(records.where(F.col("version") == version), f"{path}/arc/v{version}", version, date, archive_bytes)
    first = first_responses(convert_arc(spark, f"{path}/arc", with_blocks=False), min_bytes)
    marked = mark_revisits(convert_arc(spark, f"{path}/arc"), first, min_bytes)
    write_warc(marked, f"{path}/warc", archive_bytes)
    return read_warc(spark, f"{path}/warc").where("type in ('response', 'revisit')")
