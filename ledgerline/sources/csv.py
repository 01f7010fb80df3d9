"""CSV scans.

* by name (psql ingestion): header row gives the names (trimmed: a header
  like ``' updated_at'`` binds as ``updated_at``); every column is read as
  text so the cleaning rule sees the raw value, then cast to the declared
  schema by name.
* by position (gcp external table): declared schema, first row skipped,
  columns bound left to right whatever the header says.

Both use RFC-4180 quoting (``"a,""b"`` -> ``a,"b``) and FAILFAST, so a short
or long row raises instead of being padded. Files are split across tasks; by
position that ends where ``multi_line`` is needed for quoted newlines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.cleaning import clean_values
from ledgerline.sources.csv_records import read_csv_split


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").option("multiLine", multi_line))


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, header names trimmed. Quoted line breaks
    (``multi_line``) are found split by split, see ``csv_records``."""
    if multi_line:
        return read_csv_split(spark, path)
    df = _reader(spark, multi_line).option("inferSchema", False).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind by name and cast to the declared types (ANSI: bad text raises)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"CSV lacks declared column(s) {missing}; has {df.columns}")
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"CSV has undeclared column(s) {unknown}; declared are {schema.names}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     clean: bool = True, truncate: bool = True,
                     multi_line: bool = False) -> DataFrame:
    df = read_csv_text(spark, path, multi_line)
    if clean:
        df = clean_values(df, truncate=truncate)
    return cast_to_schema(df, schema) if schema is not None else df


def read_csv_by_position(spark: SparkSession, path: str, schema: T.StructType,
                         multi_line: bool = False) -> DataFrame:
    return (_reader(spark, multi_line).option("enforceSchema", True)
            .schema(schema).csv(path))


def force_all_columns(df: DataFrame) -> int:
    """Count with every column parsed, so FAILFAST sees malformed rows
    (a bare ``count()`` prunes columns and skips the check)."""
    # max() of a hash over all columns cannot be folded away, so every
    # column is parsed and FAILFAST sees short or long rows
    probe = F.max(F.xxhash64(*[F.col(c) for c in df.columns]))
    return df.agg(F.count(F.lit(1)).alias("n"), probe.alias("_h")).first()["n"]
