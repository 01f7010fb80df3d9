"""Helpers the operators share: row identity, checkpoints, words, sessions.

Row identity. ``with_row_id`` gives every row of a table a unique long that
rises with its id column. Where the ids are unique and not null they are used
as they are; where they repeat or are null, every row stays a document of its
own: the rows are sorted by (id, text) and numbered in that order, and the
numbered table is checkpointed so that a later re-run of a task cannot number
it differently.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import ensure_checkpoint_dir, freed_shuffles, materialize, ship_package  # noqa: F401  (operators import it from here)

#: White space that separates words: blank and the five ASCII controls 09-0D.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of the session."""
    return materialize(df)


def written(df: DataFrame) -> DataFrame:
    """Cut lineage with a Parquet table in the shared checkpoint folder; for
    tables so large that their columns are worth compressing."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Free the shuffle files of plans that nothing holds any more. Spark does so
    when the driver's garbage is collected, by itself every half hour only."""
    for _ in range(2):  # references of Python's objects are dropped with the next call
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def rows_where(df: DataFrame, flag: Column, row: str = "row") -> DataFrame:
    """The columns of the struct ``row`` where ``flag`` holds. A generator and
    not a filter: a filter would be pushed below the projections it depends on,
    and their costly expressions would be computed again inside it."""
    return df.select(F.inline(F.when(flag, F.array(row))))


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session, for explicit repartitioning."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def free_name(df: DataFrame, wish: str = "_rid") -> str:
    """A column name that ``df`` does not have, whatever the case of its names."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def with_row_id(df: DataFrame, id_col: str, text_col: str, name: str = "_rid") -> DataFrame:
    """``df`` with the unique long ``name``, rising in the order of ``id_col``.
    ``name`` must be free (``free_name``)."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {name}")
    ids = df.select(F.col(id_col).alias("k"))
    repeated = ids.groupBy("k").count().where("count > 1 OR k IS NULL")
    if isinstance(df.schema[id_col].dataType, (T.LongType, T.IntegerType)) and repeated.isEmpty():
        return df.withColumn(name, F.col(id_col).cast("long"))
    ordered = df.orderBy(F.col(id_col), F.col(text_col))
    return checkpoint(ordered.withColumn(name, F.monotonically_increasing_id()))


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, row): the unique row id beside all columns of ``df`` in a struct, so
    that no name of theirs can clash with one of an operator."""
    name = free_name(df)
    keyed = with_row_id(df, id_col, text_col, name)
    return keyed.select(F.col(f"`{name}`").alias("rid"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) of ``df``, for operators that return no other column."""
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` (null or blank text: empty)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(col, UPPER, LOWER)
