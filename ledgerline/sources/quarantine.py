"""Rejects as data. Rows of text columns are cast to a declared schema; a row
with a value that does not fit goes, with the reasons, to a table beside the
accepted rows instead of stopping the load.

A value is rejected when it cannot be cast (numbers that overflow their
DECIMAL(p,s) included), is longer than the declared length, or is NULL in a
column that must not be. One projection over the scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASONS = "reject_reasons"


def reasons(schema: T.StructType, lengths: Mapping[str, int] = {}, required: Iterable[str] = ()) -> Column:
    """Array of texts ``column: what is wrong``, empty for a row that fits."""
    found = []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType):
            found.append(F.when(raw.isNotNull() & raw.try_cast(f.dataType).isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
        if f.name in lengths:
            found.append(F.when(F.length(raw) > lengths[f.name], F.lit(f"{f.name}: longer than {lengths[f.name]}")))
        if f.name in set(required):
            found.append(F.when(raw.isNull(), F.lit(f"{f.name}: null")))
    return F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.array().cast("array<string>")


def judged(text: DataFrame, schema: T.StructType, lengths: Mapping[str, int] = {},
           required: Iterable[str] = ()) -> DataFrame:
    """The raw columns and ``reject_reasons``."""
    return text.select("*", reasons(schema, lengths, required).alias(REASONS))


def accepted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of ``judged`` without reasons, in the declared types."""
    return (rows.where(F.size(REASONS) == 0)
            .select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]))


def rejected(rows: DataFrame) -> DataFrame:
    """Rows of ``judged`` with reasons, as they came."""
    return rows.where(F.size(REASONS) > 0)
