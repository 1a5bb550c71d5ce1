"""WARC archives: writing segmented records, reading and reassembling them.

Writing.  One record per page: an HTTP response head plus the payload in
chunked transfer framing.  A block longer than ``segment_bytes`` is split into
a first ``response`` segment and ``continuation`` records that carry
``WARC-Segment-Number``, ``WARC-Segment-Origin-ID`` and, on the last,
``WARC-Segment-Total-Length``.  Records with equal payloads are written once;
the others become ``revisit`` records.  Everything is built from binary column
expressions; Spark's text writer, with the record terminator as line
separator, writes ordinary gzip-compressed WARC files into the shared folder
(bounded by ``records_per_file``).

Reading.  Files are parsed by their ``Content-Length``, never by searching for
the next record's first line, so payloads may contain anything.  Segments are
grouped by origin, ordered by number, their lengths summed and compared with the
stated total; then the chunked framing is decoded and the digest checked.  A
group is one record, so its size is bounded by one payload.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import new_folder, read_table, shared_table, small_side, text_or_empty

# Fixed values of the formats: RFC 4648 base32, WARC 1.1, HTTP/1.1.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = (
    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
)

RECORDS_SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "refers_to string, segment_number int, origin_id string, total_length bigint, "
    "content_length bigint, block binary"
)
PAYLOADS_SCHEMA = "record_id string, payload_bytes bigint, computed_digest string, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column."""
    digest = F.sha1(payload)

    def four(i):
        bits = F.conv(F.substring(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(
            *[
                F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                for s in (15, 10, 5, 0)
            ]
        )

    return F.concat(*[four(F.lit(i)) for i in range(8)])


def _bytes(s: str | Column) -> Column:
    return (F.lit(s) if isinstance(s, str) else s).cast("binary")


def _pieces(data: Column, step: int) -> Column:
    """Binary slices of at most ``step`` bytes (one empty slice for no bytes)."""
    last = F.greatest(F.ceil(F.octet_length(data) / step) - 1, F.lit(0)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(data, i * step + 1, F.lit(step))
    )


def _concat_bytes(parts: Column) -> Column:
    return F.concat_ws("", F.transform(parts, lambda p: p.cast("string"))).cast("binary")


def chunked(payload: Column, chunk_bytes: int) -> Column:
    """HTTP/1.1 chunked transfer framing of a binary column."""
    framed = F.transform(
        _pieces(payload, chunk_bytes),
        lambda p: F.when(F.octet_length(p) == 0, F.lit("")).otherwise(
            F.concat(F.lower(F.hex(F.octet_length(p))), F.lit(CRLF), p.cast("string"), F.lit(CRLF))
        ),
    )
    return F.concat(F.concat_ws("", framed), F.lit("0\r\n\r\n")).cast("binary")


def _header(pairs: list[tuple[str, Column]]) -> Column:
    """A WARC head; pairs whose value is null are left out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v.cast("string"), F.lit(CRLF))) for k, v in pairs]
    return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("", *lines), F.lit(CRLF))


def plan_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """Per page the payload's length and digest, its record type and id.

    Of records with equal payloads of at least ``min_revisit_bytes`` the one
    with the largest id is the response.  Rows that share this largest id all
    are responses.  Null ids are smaller than any id.  A group of equal
    payloads is reduced to its largest id by partial aggregation."""
    payload = _bytes(text_or_empty(html_col))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.regexp_replace(text_or_empty(url_col), r"[\r\n]", "").alias("url"),
        payload.alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    digests = rows.select("page_id", "payload_bytes", "payload_digest")
    top = digests.groupBy("payload_digest").agg(
        F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n")
    ).where(F.col("_n") > 1).select(F.col("payload_digest").alias("_d"), "_top")
    top = small_side(shared_table(top, "warc-equal"), 200_000)
    out = rows.join(top, F.col("payload_digest") == F.col("_d"), "left")
    revisit = (
        F.col("_d").isNotNull()
        & (F.col("payload_bytes") >= min_revisit_bytes)
        & ~F.col("page_id").eqNullSafe(F.col("_top"))
    )
    rid = lambda i: F.concat(
        F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("null")), F.lit(":"), F.col("payload_digest"), F.lit(">")
    )
    return out.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("_top")).alias("refers_to"),
        rid(F.col("page_id")).alias("record_id"),
        F.when(revisit, rid(F.col("_top"))).alias("refers_to_id"),
    )


def write_archives(
    planned: DataFrame, path: str, chunk_bytes: int = 4096, segment_bytes: int = 16384,
    records_per_file: int = 2000,
) -> None:
    """Write the planned records as ``.gz`` WARC files below ``path``."""
    block = F.when(
        F.col("record_type") == "response",
        F.concat(_bytes(HTTP_HEAD), chunked(F.col("payload"), chunk_bytes)),
    ).otherwise(_bytes("HTTP/1.1 304 Not Modified\r\n\r\n"))
    segs = planned.withColumn("_block", block).withColumn("_total", F.octet_length("_block"))
    segs = segs.select("*", F.posexplode(_pieces(F.col("_block"), segment_bytes)).alias("_i", "_piece"))
    many = F.col("_total") > segment_bytes
    first = F.col("_i") == 0
    last = (F.col("_i") + 1) * segment_bytes >= F.col("_total")
    seg_id = F.when(first, F.col("record_id")).otherwise(
        F.concat(F.expr("substring(record_id, 1, length(record_id) - 1)"), F.lit(":"), F.col("_i") + 1, F.lit(">"))
    )
    head = _header([
        ("WARC-Type", F.when(first, F.col("record_type")).otherwise(F.lit("continuation"))),
        ("WARC-Record-ID", seg_id),
        ("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        ("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.col("refers_to_id")),
        ("WARC-Segment-Number", F.when(many, F.col("_i") + 1)),
        ("WARC-Segment-Origin-ID", F.when(~first, F.col("record_id"))),
        ("WARC-Segment-Total-Length", F.when(many & last, F.col("_total"))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("_piece")),
    ])
    value = F.concat(_bytes(head), F.col("_piece")).cast("string").alias("value")
    segs.select(value).write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def parse_records(data: bytes) -> Iterator[tuple]:
    """The records of one WARC file, framed by their Content-Length.

    Raises ValueError on a damaged frame."""
    at, end = 0, len(data)
    while at < end:
        stop = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or stop < 0:
            raise ValueError(f"no WARC record at byte {at}")
        head = {}
        for line in data[at:stop].split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            head[k.strip().lower().decode()] = v.strip().decode("utf-8", "replace")
        size = int(head["content-length"])
        begin = stop + 4
        if begin + size + 4 > end or data[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut off")
        num = head.get("warc-segment-number")
        total = head.get("warc-segment-total-length")
        digest = head.get("warc-payload-digest")
        yield (
            head.get("warc-record-id"), head.get("warc-type"), head.get("warc-target-uri"),
            digest.removeprefix("sha1:") if digest else None, head.get("warc-refers-to"),
            int(num) if num else None, head.get("warc-segment-origin-id"),
            int(total) if total else None, size, data[begin : begin + size],
        )
        at = begin + size + 4


def _parse_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RECORDS_SCHEMA.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            data = zlib.decompress(content, 31) if content[:2] == b"\x1f\x8b" else content
            rows = list(parse_records(data))
            for i in range(0, len(rows), 500):
                out = pd.DataFrame(rows[i : i + 500], columns=names)
                for c in ("segment_number", "total_length"):
                    out[c] = out[c].astype("Int64")
                yield out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files below ``path``.

    A file is read whole (writers bound its records); compressed or plain."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_parse_files, RECORDS_SCHEMA)


def reassemble(records: DataFrame) -> DataFrame:
    """Join the segments of each record into its whole block.

    Continuations are grouped by origin identifier, ordered by segment
    number; ``complete`` says that the numbers run gapless from 1 and that the
    lengths add up to the stated total (always true of unsegmented records)."""
    whole = records.where(F.col("segment_number").isNull()).select(
        "record_id", "record_type", "target_uri", "payload_digest", "refers_to",
        F.lit(True).alias("complete"), "block",
    )
    parts = records.where(F.col("segment_number").isNotNull()).withColumn(
        "_origin", F.coalesce("origin_id", "record_id")
    ).dropDuplicates(["_origin", "segment_number"])
    first = F.col("segment_number") == 1
    grouped = parts.groupBy("_origin").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("record_type", "target_uri", "payload_digest", "refers_to")],
        F.max("total_length").alias("_total"),
        F.max("segment_number").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("content_length").alias("_sum"),
        F.sort_array(F.collect_list(F.struct("segment_number", "block"))).alias("_segs"),
    )
    joined = grouped.select(
        F.col("_origin").alias("record_id"), "record_type", "target_uri", "payload_digest", "refers_to",
        ((F.col("_n") == F.col("_last")) & F.coalesce(F.col("_sum") == F.col("_total"), F.lit(False))).alias("complete"),
        _concat_bytes(F.col("_segs.block")).alias("block"),
    )
    return whole.unionByName(joined)


def dechunk(body: bytes) -> bytes:
    """Decode chunked transfer framing (extensions and trailers allowed)."""
    out, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            raise ValueError("chunk size line is cut off")
        size = int(body[at:eol].split(b";")[0], 16)
        at = eol + 2
        if size == 0:
            return b"".join(out)
        if at + size + 2 > len(body) or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP message, its chunked framing decoded."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" in head.lower():
        return dechunk(body)
    return body


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        payloads = [http_payload(b) for b in batch["block"]]
        yield pd.DataFrame({
            "record_id": batch["record_id"],
            "payload_bytes": [len(p) for p in payloads],
            "computed_digest": [base64.b32encode(hashlib.sha1(p).digest()).decode() for p in payloads],
            "payload": payloads,
        })


def read_payloads(records: DataFrame) -> DataFrame:
    """Payload, its length and digest of every complete response record.

    An incomplete record, a damaged frame, or a digest that differs from the
    header's raises an error: archives are checked, not repaired."""
    blocks = reassemble(records).where(F.col("record_type") == "response")
    checked = blocks.select(
        "record_id", "target_uri", "payload_digest",
        F.when(F.col("complete"), F.col("block"))
        .otherwise(F.raise_error(F.concat(F.lit("segments missing of "), F.col("record_id"))).cast("binary"))
        .alias("block"),
    )
    out = checked.select("record_id", "block").mapInPandas(_decode, PAYLOADS_SCHEMA)
    return out


def op5_warc_segments(spark, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, read the archives back.

    All columns come from the archives: type, id and reference from the
    record heads, length and digest from the decoded payloads; a revisit takes
    the length of the response it refers to."""
    planned = plan_records(read_table(spark, sf_dir, "pages"))
    path = new_folder(spark, "warc")
    write_archives(planned, path)
    records = read_archives(spark, path)
    payloads = shared_table(
        read_payloads(records).select("record_id", "payload_bytes", "computed_digest"), "warc-payloads"
    )
    heads = records.where(F.col("record_type") != "continuation").select(
        "record_id", "record_type", "payload_digest", "refers_to"
    )
    source = F.coalesce("refers_to", "record_id")
    found = payloads.dropDuplicates(["record_id"]).withColumnRenamed("record_id", "_pid")
    page = lambda c: F.nullif(F.split_part(c, F.lit(":"), F.lit(3)), F.lit("null")).cast("bigint")
    good = F.col("payload_digest") == F.col("computed_digest")
    return heads.join(found, source == F.col("_pid"), "left").select(
        page(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        F.when(good, F.col("computed_digest"))
        .otherwise(F.raise_error(F.concat(F.lit("wrong digest of "), F.col("record_id"))).cast("string"))
        .alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", page(F.col("refers_to"))).alias("refers_to"),
    )


ORACLES = {
    "op5_warc_segments": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS h FROM p),
b AS (SELECT page_id, payload_bytes, array_to_string([
    substr('{BASE32}', CAST((('0x' || substr(h, CAST(i // 4 AS INTEGER) * 5 + 1, 5))::BIGINT
      >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1) for i in range(0, 32)], '') AS payload_digest FROM d),
g AS (SELECT payload_digest, max(page_id) AS top FROM b GROUP BY payload_digest)
SELECT b.page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, b.payload_digest,
  CASE WHEN b.page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN b.page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM b JOIN g ON b.payload_digest = g.payload_digest
"""
}
