"""WARC archives: write pages as records, read archives back and salvage damaged ones.

Archives are written by Spark's text writer, so the files land in any store Spark can write
to, one archive per task: each record is a gzip member of its own, and an empty member stands
between two (plain archives have the record separator there).  The reader parses
whole archive files in Arrow batches; every check that fails (version line, header block,
length, digest, gzip member) starts a search for the next valid member or version line, and
the bytes skipped are logged as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.bpe_automaton import slices
from topicloom.llm.text import inputs

# Fixed values of the format.
VERSION = "WARC/1.1"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
_CHUNK = 1 << 16
_END = b"\r\n\r\n"
_EMPTY_MEMBER = _GZIP + bytes(6) + b"\xff\x03\x00" + bytes(8)
RECORD_SCHEMA = (
    "file string, position long, record_type string, page_id long, url string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to long"
)
GAP_SCHEMA = "file string, start long, length long, reason string"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column (160 bits are 32 letters, no padding)."""
    digest = F.sha1(payload)
    letters = []
    for part in range(8):
        bits = F.conv(F.substring(digest, 1 + 5 * part, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Decide per page whether its record is a response or a revisit of an equal payload.

    ``pages``: ``_id``, ``_url``, ``_html``.  Adds ``_payload``, ``_bytes``, ``_digest``, ``_type``
    and ``_refers``.  Among equal payloads of at least ``min_bytes`` the largest id is the
    response.  A payload moves once, to the row of its digest; a digest shared by very many
    pages is a skewed left side that adaptive execution splits.
    """
    payload = F.coalesce(F.col("_html"), F.lit("")).cast("binary")
    rows = pages.select("_id", "_url", payload.alias("_payload")).withColumns(
        {"_bytes": F.octet_length("_payload").cast("long"), "_digest": base32_sha1(F.col("_payload"))}
    )
    first = rows.where(F.col("_bytes") >= min_bytes).groupBy("_digest").agg(F.max("_id").alias("_keeper"))
    joined = rows.join(first, "_digest", "left")
    revisit = (F.col("_bytes") >= min_bytes) & (F.col("_id") < F.col("_keeper"))
    return joined.select(
        "_id", "_url", "_payload", "_bytes", "_digest",
        F.when(revisit, "revisit").otherwise("response").alias("_type"),
        F.when(revisit, F.col("_keeper")).alias("_refers"),
    )


def _record(date: str) -> Column:
    """One record without its closing separator, as a string column holding the raw bytes."""
    one_line = F.regexp_replace(F.coalesce("_url", F.lit("")), r"[\x00-\x20\x7F]+", "%20")
    number = F.coalesce(F.col("_id").cast("string"), F.lit("none"))
    uuid = F.md5(F.concat_ws("|", number, F.col("_digest"), F.col("_url")))
    dashed = F.regexp_replace(uuid, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    revisit = F.col("_type") == "revisit"
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("_payload"))
    end = "\r\n"
    head = F.concat(
        F.lit(f"{VERSION}{end}WARC-Type: "), "_type",
        F.lit(f"{end}WARC-Record-ID: <urn:uuid:"), dashed,
        F.lit(f">{end}WARC-Date: {date}{end}WARC-Target-URI: "), one_line,
        F.lit(f"{end}WARC-Payload-Digest: sha1:"), "_digest",
        F.lit(f"{end}X-Page-Id: "), number,
        F.lit(f"{end}X-Payload-Length: "), F.col("_bytes").cast("string"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"{end}WARC-Profile: {REVISIT_PROFILE}{end}X-Refers-To-Page: "),
                F.col("_refers").cast("string"),
            ),
        ).otherwise(""),
        F.lit(f"{end}Content-Type: application/octet-stream{end}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(end + end),
    )
    return F.concat(head.cast("binary"), body)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0)
        for start, length in slices(values):
            members = []
            for record in values.slice(start, length).to_pylist():
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                members.append(packer.compress(record) + packer.compress(_END) + packer.flush())
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    compress: bool = True,
) -> None:
    """Write one record per row of ``pages`` below ``path``.

    Null html is an empty payload, a null url an empty header, a null id is written as
    ``none`` and is always a response.  Rows that share id and payload are all responses
    (no record revisits itself).
    """
    rows = with_revisits(inputs(pages, _id=id_col, _url=url_col, _html=html_col), min_bytes)
    records, between = rows.select(_record(date).alias("value")), _END
    if compress:
        records, between = records.mapInArrow(_compressed, "value binary"), _EMPTY_MEMBER
    # A string column holds the raw bytes; the separator is given in one byte per letter.
    records.select(F.col("value").cast("string")).write.options(
        lineSep=between.decode("latin-1"), encoding="ISO-8859-1"
    ).text(path)


def _number(value: bytes | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(rb"-?[0-9]+", value) else None


def parse_records(data: bytes) -> Iterator[tuple]:
    """Records and gaps of uncompressed archive bytes, in order of position.

    Yields ``("record", position, headers, payload)`` and ``("gap", position, length, reason)``.
    A record counts only when its length fits, the separator follows (or the data ends) and
    the digest of a stored payload agrees.
    """
    at, size, gap, why = 0, len(data), None, ""
    while at < size:
        problem = ""
        start = _START.match(data, at)
        split = data.find(b"\r\n\r\n", at) if start else -1
        headers, payload, end = {}, b"", at
        if not start:
            problem = "no version line"
        elif split < 0:
            problem = "header block not closed"
        else:
            for line in data[start.end() : split].split(b"\r\n"):
                key, colon, value = line.partition(b":")
                headers[key.strip().lower()] = value.strip()
            length = _number(headers.get(b"content-length"))
            end = split + 4 + (length or 0)
            digest = headers.get(b"warc-payload-digest", b"").removeprefix(b"sha1:")
            if length is None or length < 0:
                problem = "no content length"
            elif end > size:
                problem = "truncated payload"
            elif data[end : end + 4] != b"\r\n\r\n" and end != size:
                problem = "no separator after payload"
            else:
                payload = data[split + 4 : end]
                if headers.get(b"warc-type") != b"revisit" and digest:
                    if base64.b32encode(hashlib.sha1(payload).digest()) != digest:
                        problem = "digest differs"
        if problem:
            if gap is None:
                gap, why = at, problem
            found = _START.search(data, at + 1)
            at = found.start() if found else size
            continue
        if gap is not None:
            yield "gap", gap, at - gap, why
            gap = None
        yield "record", at, headers, payload
        at = min(end + 4, size)
    if gap is not None:
        yield "gap", gap, size - gap, why


def _members(data: bytes) -> Iterator[tuple]:
    """Gzip members as ``("data", position, bytes)``; bytes in no valid member as gaps."""
    at, size, gap = 0, len(data), None
    while at < size:
        inflater, parts, end = zlib.decompressobj(31), [], at
        try:
            while data.startswith(_GZIP, at) and not inflater.eof and end < size:
                parts.append(inflater.decompress(data[end : end + _CHUNK]))
                end = min(end + _CHUNK, size)
        except zlib.error:
            parts = []
        if not inflater.eof:
            gap = at if gap is None else gap
            found = data.find(_GZIP, at + 1)
            at = found if found >= 0 else size
            continue
        if gap is not None:
            yield "gap", gap, at - gap, "invalid gzip member"
            gap = None
        yield "data", at, b"".join(parts)
        at = end - len(inflater.unused_data)
    if gap is not None:
        yield "gap", gap, size - gap, "invalid gzip member"


def salvage(data: bytes) -> Iterator[tuple]:
    """``parse_records`` over plain archives and over archives of gzip members.

    Positions inside a member are given as the member's own position.
    """
    member, version = data.find(_GZIP), data.find(b"WARC/1.")
    if member < 0 or 0 <= version < member:
        yield from parse_records(data)
        return
    for kind, position, *rest in _members(data):
        if kind == "gap":
            yield kind, position, *rest
            continue
        for item in parse_records(rest[0]):
            yield item[0], position, *item[2:]


def _rows(name: str, data: bytes) -> Iterator[tuple]:
    for kind, position, first, second in salvage(data):
        if kind == "gap":
            yield (name, position, "gap", None, second, None, first, None, None)
            continue
        kind = first.get(b"warc-type", b"").decode("utf-8", "replace")
        stored = kind != "revisit"
        digest = first.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("ascii", "replace")
        yield (
            name, position, kind, _number(first.get(b"x-page-id")),
            first.get(b"warc-target-uri", b"").decode("utf-8", "replace"),
            second if stored else None,
            len(second) if stored else _number(first.get(b"x-payload-length")),
            base64.b32encode(hashlib.sha1(second).digest()).decode() if stored else digest,
            _number(first.get(b"x-refers-to-page")),
        )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records below ``path`` plus one row of type ``gap`` per quarantined byte range.

    Gap rows carry the length in ``payload_bytes`` and the reason in ``url``.  An empty file has
    no rows.  One file is parsed in one task, so archives should stay below some hundred MB,
    as those of ``write_archives`` do.  A folder without files gives no rows.
    """
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                rows, held = [], 0
                for row in _rows(name, data):
                    row = row if with_payload else (*row[:5], None, *row[6:])
                    rows.append(row)
                    held += len(row[5] or b"")
                    if len(rows) >= 5000 or held > 16 << 20:
                        yield _frame(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(parse, RECORD_SCHEMA)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c in ("position", "page_id", "payload_bytes", "refers_to")})


def gaps(records: DataFrame) -> DataFrame:
    """The quarantine log: file, start, length, reason."""
    return records.where(F.col("record_type") == "gap").select(
        "file", F.col("position").alias("start"), F.col("payload_bytes").alias("length"), F.col("url").alias("reason")
    )
