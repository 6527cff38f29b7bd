"""WARC archives: written as one gzip stream per file, then normalised to one gzip member per record with an offset index.

``write_archives`` renders a record per page and lets Spark's text writer compress each file as a whole, which gives the
monolithic archives that crawlers often leave. ``normalise`` inflates such a file once, front to back, cuts it into records by
their Content-Length, compresses every record as a member of its own, and keeps (archive, record, offset, length) beside it, so
that any record can be read without inflating those before it. ``read_records`` reads archives back by that index.

Of pages with equal payloads of at least ``min_revisit`` bytes, the one with the smallest id holds the payload; the others are
revisit records with its digest and length. Rows that repeat this page id and payload are responses too.

Null html is an empty payload, a null url an empty one. Pages without id are not written. Line breaks in urls are escaped.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.session import scratch_dir

MIN_REVISIT = 100
PAGES_PER_FILE = 2000
LEVEL = 1
END = b"\r\n\r\n"


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, record): the text of each page's WARC record, without the line breaks that end it."""
    pages = pages.where(F.col("page_id").isNotNull()).select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    size = F.octet_length("html").cast("long")
    pages = pages.withColumns({"size": size, "digest": F.sha2("html", 256)})
    # Only digests with several pages are joined back; their first page is found with a map-side minimum.
    firsts = pages.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    pages = pages.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("first") != F.col("page_id"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("page_id").cast("string"), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), url), F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")), F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")), F.lit("\r\n"))
    return pages.select("page_id", F.concat(head, body).alias("record"))


def write_archives(pages: DataFrame, path: str, pages_per_file: int = PAGES_PER_FILE, min_revisit: int = MIN_REVISIT) -> None:
    """Monolithic ``.gz`` archives below ``path``: every file one gzip stream of records."""
    (records(pages, min_revisit).select("record").write.option("compression", "gzip").option("lineSep", END.decode())
     .option("maxRecordsPerFile", pages_per_file).text(path))


def _inflated(content: bytes, step: int = 1 << 20):
    """The bytes of a gzip file, member after member, in pieces."""
    view, at = memoryview(content), 0
    tool = zlib.decompressobj(31)
    while at < len(view):
        piece = view[at:at + step]
        at += len(piece)
        while True:
            yield tool.decompress(piece)
            if not tool.eof:
                break
            piece = tool.unused_data.lstrip(b"\0")
            tool = zlib.decompressobj(31)
            if not piece:
                break


def cut(stream):
    """Whole records (head, body) of a WARC stream given in pieces; holds one record and a piece at a time."""
    held = bytearray()
    head = None
    for piece in stream:
        held += piece
        start = 0
        while True:
            if head is None:
                end = held.find(END, start)
                if end < 0:
                    break
                head, start = bytes(held[start:end + 4]), end + 4
                need = int(next(line.split(b":", 1)[1] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")))
            if len(held) - start < need + 4:
                break
            yield head, bytes(held[start:start + need])
            start += need + 4
            head = None
        del held[:start]
    if head is not None or held.strip():
        raise ValueError("the archive ends inside a record")


def _member(raw: bytes) -> bytes:
    tool = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return tool.compress(raw) + tool.flush()


def fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in head.decode().split("\r\n")[1:] if ":" in line)}


INDEX = "archive string, record_id string, offset long, length long"


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the archives below ``source`` as Parquet rows below ``target``: the member-wise archive and its sidecar index."""
    files = spark.read.format("binaryFile").load(source).select("path", "content")

    def rewrite(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                out, offsets, lengths, names, at = [], [], [], [], 0
                for head, body in cut(_inflated(content)):
                    member = _member(head + body + END)
                    out.append(member)
                    offsets.append(at)
                    lengths.append(len(member))
                    names.append(fields(head).get("warc-record-id", ""))
                    at += len(member)
                yield pd.DataFrame({"archive": [path.rsplit("/", 1)[-1]], "content": [b"".join(out)], "record_ids": [names], "offsets": [offsets], "lengths": [lengths]})

    files.mapInPandas(rewrite, "archive string, content binary, record_ids array<string>, offsets array<long>, lengths array<long>").write.parquet(target)


def archive_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar index: one row per record."""
    rows = spark.read.parquet(target).select("archive", F.explode(F.arrays_zip("record_ids", "offsets", "lengths")).alias("r"))
    return rows.select("archive", F.col("r.record_ids").alias("record_id"), F.col("r.offsets").alias("offset"), F.col("r.lengths").alias("length"))


def read_records(spark: SparkSession, target: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, body): every record, read at its offset.

    Size and digest of a response are those of the bytes read; if its header tells others, the archive is damaged and reading fails.
    """

    def read(frames):
        for frame in frames:
            for content, offsets, lengths in zip(frame["content"], frame["offsets"], frame["lengths"]):
                rows = []
                for at, size in zip(offsets, lengths):
                    raw = zlib.decompress(content[at:at + size], 31)
                    end = raw.index(END) + 4
                    head, body = fields(raw[:end]), raw[end:-4]
                    refers = head.get("warc-refers-to")
                    size, digest = int(head["x-payload-length"]), head["warc-payload-digest"].removeprefix("sha256:")
                    if refers is None:  # the payload is here: what is returned comes from its bytes
                        told, size, digest = (size, digest), len(body), hashlib.sha256(body).hexdigest()
                        if told != (size, digest):
                            raise ValueError(f"{head['warc-record-id']}: the payload is not the one that was written")
                    rows.append((_number(head["warc-record-id"]), head["warc-target-uri"], size, digest, head["warc-type"], _number(refers) if refers else None, body))
                yield pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "body"]).astype({"refers_to": "Int64"})

    return spark.read.parquet(target).select("content", "offsets", "lengths").mapInPandas(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, body binary")


def _number(urn: str) -> int:
    return int(urn.strip("<>").rsplit(":", 1)[1])


def round_trip(pages: DataFrame, pages_per_file: int = PAGES_PER_FILE, min_revisit: int = MIN_REVISIT) -> DataFrame:
    spark = pages.sparkSession
    source, target = scratch_dir(spark, "warc"), scratch_dir(spark, "warc-members")
    write_archives(pages, source, pages_per_file, min_revisit)
    normalise(spark, source, target)
    return read_records(spark, target)
