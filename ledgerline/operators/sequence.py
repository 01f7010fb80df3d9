"""Dense, rising sequence keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` would pull every row into one task. Here:

1. range-partition by the order columns and sort inside each partition;
2. checkpoint (reliable, shared folder), so partition contents and order are
   fixed even if a task or executor is lost and recomputed;
3. per row: partition id and its index inside the partition
   (``monotonically_increasing_id`` minus its partition bits);
4. count rows per partition - one small row per partition - and turn the
   counts into start offsets (bounded by the partition count, so the offset
   table is safe to broadcast);
5. key = start + offset + index + 1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import materialize

_ROW_BITS = (1 << 33) - 1
INT4_MAX = 2**31 - 1


@dataclass
class KeySequence:
    """Last key handed out (what backs a ``serial`` column). ``None`` means
    unknown: the next user scans the table once for its max key."""

    value: int | None = None


def assign_sequence(df: DataFrame, order_cols: list[str], start: int, col: str,
                    key_type: T.DataType = T.LongType(),
                    num_partitions: int | None = None,
                    seq: KeySequence | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    fixed = materialize(ranged)
    tagged = (fixed.withColumn("_pid", F.spark_partition_id())
              .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))))
    counts = sorted((r["_pid"], r["n"]) for r in
                    tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, running = [], 0
    for pid, cnt in counts:
        offsets.append((pid, running))
        running += cnt
    if isinstance(key_type, T.IntegerType) and start + running > INT4_MAX:
        raise OverflowError(f"{col}: sequence would pass the int4 range "
                            f"({start} + {running} > {INT4_MAX})")
    if seq is not None:
        seq.value = start + running
    off_df = spark.createDataFrame(offsets, "_pid int, _off long")
    keyed = tagged.join(F.broadcast(off_df), "_pid")
    key = (F.lit(start).cast("long") + F.col("_off") + F.col("_row") + F.lit(1)).cast(key_type)
    return keyed.withColumn(col, key).drop("_pid", "_row", "_off")


def next_start(seq: KeySequence | None, table: DataFrame | None, col: str) -> int:
    """Start of the next keys: the sequence's value, else the table's max."""
    if seq is not None and seq.value is not None:
        return seq.value
    return max_key(table, col) if table is not None else 0


def max_key(df: DataFrame, col: str) -> int:
    """Current largest key (0 for an empty table): one scalar to the driver."""
    v = df.agg(F.max(col).alias("m")).first()["m"]
    return int(v) if v is not None else 0
