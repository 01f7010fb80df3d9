"""S1 for large files with quoted line breaks.

Spark's ``multiLine`` reader gives a whole file to one task. Here a file is read
by splits, as lines, and the record boundaries are found from quote parity: a
line break lies inside a quoted field exactly when an odd number of quotes stands
before it in the file (a doubled quote counts twice and changes nothing).

1. every split: quotes modulo 2, and how many records would start in it if it
   began outside, or inside, a quoted field; one row per split;
2. a running sum of those rows per file tells where each split really begins and
   how many records come before it;
3. every split again: its lines are put together to records. Only the pieces of
   records that cross a split boundary, at most two a split, are shuffled.

Records are then parsed by Spark's own ``from_csv``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import ship_package

QUOTE = '"'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines by split: file, first byte of the split, text, quotes modulo 2."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"),
                       ((F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))) % 2).cast("tinyint").alias("odd"))


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(file, block) and the rows of a batch that belong to it."""
    block = batch.column(1).to_numpy(zero_copy_only=False)
    name = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cut = np.flatnonzero((np.diff(block) != 0) | (np.diff(name) != 0)) + 1
    for a, b in zip([0, *cut], [*cut, len(block)], strict=True):
        if b > a:
            yield (batch.column(0)[int(a)].as_py(), int(block[a])), int(a), int(b)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple, list[int]] = {}
    for batch in batches:
        odd = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        for key, a, b in _stretches(batch):
            s = seen.setdefault(key, [0, 0, 0])
            before = (s[0] + np.concatenate([[0], np.cumsum(odd[a:b])[:-1]])) % 2
            s[1] += int((before == 0).sum())
            s[2] += int((before == 1).sum())
            s[0] = (s[0] + int(odd[a:b].sum())) % 2
    if seen:
        rows = [(f, k, *s) for (f, k), s in seen.items()]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                         ["file", "block", "odd", "even_starts", "odd_starts"])


RECORD = "file string, record long, block long, text string, whole boolean"


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one split; pieces of the others. Rows carry what step
    2 found for their split: ``inside`` (begins in a quoted field), ``before``."""
    key, parts, number, inside, headless = None, [], 0, 0, False
    for batch in batches:
        out: list[tuple] = []
        lines, odd = batch.column(2).to_pylist(), batch.column(3).to_numpy(zero_copy_only=False)
        starts, befores = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        for new, a, b in _stretches(batch):
            if new != key:
                if parts:
                    out.append((*_at(key, number), "\n".join(parts), not headless and not inside))
                key, parts, number, inside = new, [], befores[a] - 1, starts[a]
                headless = bool(inside)
            for i in range(a, b):
                if not inside:
                    if parts:
                        out.append((*_at(key, number), "\n".join(parts), not headless))
                    parts, number, headless = [], number + 1, False
                parts.append(lines[i])
                inside ^= int(odd[i])
        yield _records(out)
    if parts:
        yield _records([(*_at(key, number), "\n".join(parts), not headless and not inside)])


def _at(key: tuple, number: int) -> tuple:
    return key[0], number, key[1]


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    cols = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [c.split()[0] for c in RECORD.split(", ")])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): every record of every file, numbered from 0."""
    ship_package(spark)
    lines = _lines(spark, path)
    splits = lines.select("file", "block", "odd").mapInArrow(_count, "file string, block long, odd int, even_starts long, odd_starts long")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int"))
    starts = F.when(F.col("inside") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))
    splits = splits.select("file", "block", "inside", F.coalesce(F.sum(starts).over(earlier), F.lit(0)).alias("before"))
    # one row a split (128 MB of text or so) reaches the driver and every task: the lines
    # of a split must stay in order, so they cannot be shuffled to a join
    known = {(r["file"], r["block"]): (r["inside"], r["before"]) for r in splits.collect()}
    state = spark.sparkContext.broadcast(known)

    def with_state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def widened():
            for batch in batches:
                inside, before = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                for key, a, b in _stretches(batch):
                    inside[a:b], before[a:b] = state.value[key]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inside), pa.array(before)], [*batch.schema.names, "inside", "before"])
        return _assemble(widened())

    pieces = lines.mapInArrow(with_state, RECORD)
    crossing = (pieces.where(~F.col("whole")).groupBy("file", "record")
                .agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("p"))
                .select("file", "record", F.array_join(F.col("p.text"), "\n").alias("text")))
    return pieces.where("whole").select("file", "record", "text").unionByName(crossing)


def read_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, header names trimmed, like ``read_csv_text`` with
    ``multi_line``, but read by as many tasks as the files have splits. A short
    or long row raises. Blank lines between records are skipped."""
    names = [c.strip() for c in spark.read.option("header", True).option("quote", QUOTE).option("escape", QUOTE).csv(path).columns]
    rows = read_records(spark, path).where(F.col("record") > 0).select(F.regexp_replace("text", "\r$", "").alias("text"))
    rows = rows.where(F.trim("text") != "")
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    parsed = rows.select(F.from_csv("text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                                    {"quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*").toDF(*names)
