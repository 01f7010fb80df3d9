"""WARC archives: writing, and reading back by a chain of verified boundaries.

Writing. Pages with equal payloads are found by digest; the smallest page_id is
written as a response, the others as revisits that name it. Records go through
Spark's text writer: the end-of-record mark is its line separator.

Reading. The archives are read as text split at the record magic, so files are
split freely between tasks. A piece that follows a magic is a candidate record;
its Content-Length gives the offset where its successor must start. Within a
task's block the chains of successors are followed locally; across blocks,
pointer jumping from each file's start finds the block entries that are really
reached. Only records on the chain are kept, so a magic inside a payload is no
record. Only offsets and headers are shuffled, never payloads. A chain that does
not end where its file ends raises (``strict``), as records behind the break
would be lost in silence.

Defined results: null html is an empty payload; rows that share a page_id, or
have none, are records of their own (ties go by html); line breaks in a url are
removed. Length and digest of a response are those of the payload read; where
the header names a SHA-1 or a length of the writer's, ``verified`` says whether
they agree. A payload that runs on into another block of the file has its
measured length, and the header's digest (``verified`` is null). A revisit has no payload,
so what its header says is returned. Records of other types and of other
writers, with the standard headers alone, are read too: columns that only this
writer's headers fill are null. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint, ship_package, text_or_empty, with_row_id, written
from ledgerline.session import ensure_checkpoint_dir

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 upper-case base32 characters, five hex digits at a time."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the last column, so that the join moves less."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = pa.array([squeeze(x.as_py().encode()) for x in batch.column(batch.num_columns - 1)], pa.binary())
        yield batch.set_column(batch.num_columns - 1, "html", packed)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = pa.array([unpack(x.as_py()).decode() if x.is_valid else None for x in batch.column(batch.num_columns - 1)], pa.string())
        yield batch.set_column(batch.num_columns - 1, "html", texts)


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) under ``path``."""
    keyed = with_row_id(pages.select("page_id", "url", "html"), "page_id", "html")
    html = text_or_empty("html")
    rows = keyed.select("_rid", F.col("page_id").cast("long"), F.translate(text_or_empty("url"), "\r\n", "").alias("url"), html.alias("html"),
                        base32_sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))
    firsts = checkpoint(rows.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest", "bytes")
                        .agg(F.min(F.struct("_rid", "page_id")).alias("first"), F.count("*").alias("n")).where("n > 1")
                        .select("digest", "bytes", "first"))
    ship_package(pages.sparkSession)
    squeezed = rows.select("_rid", "page_id", "url", "digest", "bytes", "html").mapInArrow(
        _squeeze, "_rid long, page_id long, url string, digest string, bytes long, html binary")
    joined = squeezed.join(firsts, ["digest", "bytes"], "left")
    revisit = F.coalesce(F.col("first._rid") != F.col("_rid"), F.lit(False))
    joined = joined.select("_rid", "page_id", "url", "digest", "bytes", "first", F.when(~revisit, F.col("html")).alias("html")).mapInArrow(
        _unpack, "_rid long, page_id long, url string, digest string, bytes long, first struct<_rid:long,page_id:long>, html string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(END))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:x-row:"), F.col("_rid"), F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.col("url"),
        F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id")), F.lit("")),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:x-row:"),
            F.col("first._rid"), F.lit(">"), F.coalesce(F.concat(F.lit("\r\nX-Refers-To-Page-Id: "), F.col("first.page_id")), F.lit(""))))
        .otherwise(F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nX-Payload-Length: "), F.col("bytes"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit(END))
    joined.select(F.concat(head, block).alias("value")).write.option("lineSep", END).text(path)


CANDIDATE = ("file string, block long, rel long, succ long, leaves long, page_id long, url string, record_type string, "
             "refers_to long, payload_bytes long, payload_digest string, verified boolean, consumed long")
_FIELD = re.compile(rb"([A-Za-z0-9-]+): ?([^\r\n]*)")


class _Block:
    """Candidates of one stretch of a file that one task reads in order."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.at, self.rows = file, block, 0, []
        self.open: list[tuple] = []  # records whose payload runs on into later pieces

    def piece(self, value: bytes, follows_magic: bool) -> None:
        mark = MAGIC.encode()
        start = self.at - len(mark)
        still = []
        for row, digest, left in self.open:
            part = (mark + value)[:left]
            digest.update(part)
            if left - len(part) > 0:
                still.append((row, digest, left - len(part)))
            else:
                self._seal(row, digest)
        self.open = still
        if follows_magic:
            self._candidate(value, start)
        self.at += len(value) + len(mark)

    def _seal(self, row: list, digest) -> None:
        """Put what was read into the row, and whether the headers said the same."""
        read, named, size = base64.b32encode(digest.digest()).decode(), row[10], row[11]
        row[11] = None if named is None and size is None else named in (None, read) and size in (None, row[9])
        row[10] = read

    def _candidate(self, value: bytes, start: int) -> None:
        head_end = value.find(END.encode())
        if head_end < 0:
            return
        fields = {k.lower(): v for k, v in _FIELD.findall(value[:head_end])}
        try:
            length, kind = int(fields[b"content-length"]), fields[b"warc-type"].decode()
            size = int(fields[b"x-payload-length"]) if b"x-payload-length" in fields else None
            method, _, digest = fields.get(b"warc-payload-digest", b"").decode().partition(":")
            digest = digest if method == "sha1" else None
            page = int(fields[b"x-page-id"]) if b"x-page-id" in fields else None
            refers = int(fields[b"x-refers-to-page-id"]) if b"x-refers-to-page-id" in fields else None
            url = fields.get(b"warc-target-uri", b"").decode()
        except (KeyError, ValueError, UnicodeDecodeError):
            return
        body = head_end + len(END)
        succ = start + len(MAGIC) + body + length + len(END)
        row = [self.file, self.block, start, succ, succ, page, url, kind, refers, size, digest, None, 0]
        if kind != "revisit":
            payload_at = value.find(END.encode(), body, body + length) if fields.get(b"content-type", b"").startswith(b"application/http") else body - len(END)
            payload_at = body if payload_at < 0 else payload_at + len(END)
            row[9], row[11] = body + length - payload_at, size
            here = value[payload_at:body + length]
            h = hashlib.sha1(here)
            left = body + length - max(payload_at, len(value)) if body + length > len(value) else 0
            if left > 0:
                self.open.append((row, h, left))
            else:
                self._seal(row, h)
        self.rows.append(row)

    def close(self) -> list[list]:
        for row, _, _ in self.open:  # runs on into another block: not compared
            row[11] = None
        leaves: dict[int, int] = {}
        for row in reversed(self.rows):  # where the chain from here leaves the block
            row[4] = leaves[row[2]] = leaves.get(row[3], row[3])
        self.rows.append([self.file, self.block, None, None, None, None, None, None, None, None, None, None, self.at])
        return self.rows


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]])
                        for c in CANDIDATE.split(", ")])
    current = None

    def flush(b):
        return pa.record_batch([pa.array(col, f.type) for col, f in zip(zip(*b.close(), strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        files, blocks, values = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(0)
        for i, (file, block) in enumerate(zip(files, blocks, strict=True)):
            fresh = current is None or (current.file, current.block) != (file, block)
            if fresh:
                if current is not None:
                    yield flush(current)
                current = _Block(file, block)
            # the first piece of a file stands before its first magic
            current.piece(values[i].as_py(), not (fresh and block == 0))
    if current is not None:
        yield flush(current)


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """Records of one block that are reached from its entries."""
    succ = dict(zip(pdf["off"], pdf["end"], strict=True))
    reached = set()
    for at in pdf.loc[pdf["entry"], "off"]:
        while at in succ and at not in reached:
            reached.add(at)
            at = succ[at]
    return pdf.loc[pdf["off"].isin(reached), ["file", "off"]]


def read_archive(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Records on the chain: file, offset, page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, verified, chain_whole (whether the
    file's chain ends where the file does; ``strict``: raise if not)."""
    ship_package(spark)
    pieces = (spark.read.option("lineSep", MAGIC).text(path)
              .select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block")))
    found = written(pieces.mapInArrow(_candidates, CANDIDATE))
    blocks = found.where("rel IS NULL").select("file", "block", "consumed")
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = checkpoint(blocks.withColumn("base", F.coalesce(F.sum("consumed").over(order), F.lit(0))).drop("consumed"))
    cand = found.where("rel IS NOT NULL").drop("consumed").join(bases, ["file", "block"]).select(
        "*", (F.col("base") + F.col("rel")).alias("off"), (F.col("base") + F.col("succ")).alias("end"),
        (F.col("base") + F.col("leaves")).alias("next")).drop("rel", "succ", "leaves", "base")
    entries = cand.select("file").distinct().select("file", F.lit(0).cast("long").alias("off"))
    hops = bases.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    jump = cand.select("file", "off", "next")
    while hops > 1:  # entries reached by up to 2**k block changes; jump doubles each time
        step = entries.join(jump, ["file", "off"]).select("file", F.col("next").alias("off"))
        entries = written(entries.union(step).distinct())
        onward = jump.select("file", F.col("off").alias("next"), F.col("next").alias("then"))
        jump = written(jump.join(onward, ["file", "next"], "left").select(
            "file", "off", F.coalesce("then", "next").alias("next")))
        hops = (hops + 1) // 2
    marked = cand.select("file", "block", "off", "end").join(
        entries.withColumn("entry", F.lit(True)), ["file", "off"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    kept = marked.groupBy("file", "block").applyInPandas(_walk, "file string, off long")
    records = cand.join(kept, ["file", "off"], "left_semi")
    # pieces were counted with a magic each, of which a file has one less than pieces
    length = blocks.groupBy("file").agg((F.sum("consumed") - len(MAGIC)).alias("length"))
    whole = checkpoint(length.join(records.groupBy("file").agg(F.max("end").alias("last")), "file", "left")
                       .select("file", F.coalesce((F.col("last") == F.col("length")) | (F.col("length") == 0), F.lit(False)).alias("chain_whole")))
    broken = [r["file"] for r in whole.where("NOT chain_whole").limit(3).collect()]
    if strict and broken:
        raise ValueError(f"the chain of records breaks in {', '.join(broken)}")
    return records.join(whole, "file").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file",
        F.col("off").alias("offset"), "verified", "chain_whole")


def roundtrip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder and read it back."""
    spark = pages.sparkSession
    where = path or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, where)
    return read_archive(spark, where)
