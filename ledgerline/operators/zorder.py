"""K8: clustering by several keys along a Z-order curve.

A lexical sort lets a reader skip row groups by its first key only. Here the
buckets of all keys are interleaved bit by bit, so a range of the curve is a
small box in every key, and row groups carry narrow bounds for each of them.

Buckets: numbers by their approximate quantiles (one aggregate, a bounded
sketch), texts that are hash keys by their leading hex digits, which are
uniform; other texts by a quantile of their leading bytes as a number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8


def _number(df: DataFrame, col: str) -> Column:
    """A number that rises with the column's values (texts: their first 7 bytes)."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.substring(F.rpad(F.hex(F.encode(F.col(col), "UTF-8")), 14, "0"), 1, 14), 16, 10).cast("long").cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_timestamp(F.col(col).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    return F.col(col).cast("double")


def _bucket(value: Column, cuts: list[float], bits: int) -> Column:
    """How many of the ``2**bits - 1`` rising cuts a value reaches: a binary search."""
    held = F.array(*[F.lit(float(x)) for x in cuts])
    steps = F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])

    def reached(v: Column) -> Column:
        return F.when(v.isNull(), 0).otherwise(
            F.aggregate(steps, F.lit(0), lambda n, step: F.when(v >= F.element_at(held, n + step), n + step).otherwise(n)))

    return F.element_at(F.transform(F.array(value), reached), 1)  # the value is computed once, not at each step


def curve(df: DataFrame, cols: list[str], bits: int = BITS) -> Column:
    """Z-order position of a row as a long (``bits`` per key, at most 62 in all); NULL counts as the
    smallest value."""
    bits = min(bits, 62 // len(cols))
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(_number(df, c), steps, 1000).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    # bit b of a bucket goes to bit b * keys of the position, one place on for each key
    spread = F.array(*[F.lit(sum((p >> b & 1) << b * len(cols) for b in range(bits))).cast("long") for p in range(1 << bits)])
    parts = [F.shiftleft(F.element_at(spread, _bucket(_number(df, c), bounds[f"b{i}"], bits) + 1), i)
             for i, c in enumerate(cols) if bounds[f"b{i}"]]
    return reduce(Column.bitwiseOR, parts) if parts else F.lit(0).cast("long")
