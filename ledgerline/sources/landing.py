"""Batch landing under a run stamp, and the view over one batch.

Layout: ``<root>/<stamp>/<table>/`` (the files as they came, or CSV written by
Spark; one folder per table). A stamp folder is never overwritten; a
``LANDED`` marker (holding the stamp) is written last, so readers only trust
complete batches. (Not ``_``-prefixed: Spark's file listing skips those.)
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.session import ship_package
from ledgerline.sources.csv import read_csv_by_position

MARKER = "LANDED"
CHUNK = 8 << 20


def batch_path(root: str, stamp: str, table: str) -> str:
    return os.path.join(root, stamp, table)


def land_batch(df: DataFrame, root: str, table: str, stamp: str) -> str:
    path = batch_path(root, stamp, table)
    (df.write.mode("errorifexists").option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))
    return path


def _client(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system client and path, on an executor (``file:``, ``hdfs:``,
    ``s3:``, ``gs:``, ``abfs:``; an ``s3a:`` path is an S3 path)."""
    return pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", re.sub("^s3[an]:", "s3:", uri)))


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One file per row, byte for byte: written under a hidden name that only this
    attempt uses, and renamed when it is complete."""
    for batch in batches:
        sizes = []
        for source, folder, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            from_fs, from_path = _client(source)
            fs, path = _client(folder)
            fs.create_dir(path, recursive=True)
            part = f"{path}/_{name}.{uuid.uuid4().hex}.part"
            with from_fs.open_input_stream(from_path) as src, fs.open_output_stream(part) as out:
                shutil.copyfileobj(src, out, CHUNK)
            size = fs.get_file_info(part).size
            if size != from_fs.get_file_info(from_path).size:
                raise OSError(f"{source} changed while it was copied")
            fs.move(part, f"{path}/{name}")
            sizes.append(size)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["source", "bytes"])


def land_files(spark: SparkSession, files: dict[str, str], root: str, stamp: str) -> dict[str, str]:
    """Copy CSV files or folders (table -> path) byte for byte into the stamp folder.

    The driver lists names; tasks copy, a file each, so no byte passes the driver
    and nothing is parsed: blanks, short rows and quoted line breaks reach the
    reader as they were sent. A killed task leaves a hidden part file, which the
    reader skips and the end of the copy removes. The stamp is marked after the last file; an
    existing file is an error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    listed, out = [], {}
    for table, src in files.items():
        source, folder = hadoop.Path(src), hadoop.Path(batch_path(root, stamp, table))
        fs, from_fs = folder.getFileSystem(conf), source.getFileSystem(conf)
        out[table] = folder.toString()
        found = from_fs.listStatus(source)
        for st in found:
            name = st.getPath().getName()
            if st.isDirectory() or (len(found) > 1 and name[0] in "._"):
                continue
            if fs.exists(hadoop.Path(folder, name)):
                raise FileExistsError(f"{folder}/{name}")
            listed.append((from_fs.makeQualified(st.getPath()).toString(), fs.makeQualified(folder).toString(), name))
    if listed:
        ship_package(spark)
        todo = spark.createDataFrame(listed, "source string, folder string, name string").repartition(len(listed))
        todo.mapInArrow(_copy, "source string, bytes long").agg({"bytes": "sum"}).collect()
    for table in files:
        folder = hadoop.Path(out[table])
        fs = folder.getFileSystem(conf)
        for st in fs.globStatus(hadoop.Path(folder, "_*.part")) or []:
            fs.delete(st.getPath(), False)
    mark_landed(spark, root, stamp)
    return out


def mark_landed(spark: SparkSession, root: str, stamp: str) -> None:
    spark.createDataFrame([(stamp,)], "stamp string").coalesce(1).write.mode("overwrite") \
        .text(os.path.join(root, stamp, MARKER))


def batch_view(spark: SparkSession, root: str, stamp: str, table: str,
               schema: T.StructType, view: str | None = None, multi_line: bool = False) -> DataFrame:
    """External-table equivalent: exactly one batch, bound by position."""
    df = read_csv_by_position(spark, batch_path(root, stamp, table), schema, multi_line)
    df.createOrReplaceTempView(view or table)
    return df
