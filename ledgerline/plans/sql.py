"""Parameterised query text.

Statements lie in ``ledgerline/plans/statements/*.sql`` (or any folder) and run
through ``spark.sql(text, args)``: values and table names are named parameter
markers (``:run_ts``, ``IDENTIFIER(:dim)``), bound by Spark, never pasted into
the text. A marker without a value, and a value without a marker, is an error.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

STATEMENTS = Path(__file__).parent / "statements"
_MARKER = re.compile(r"(?<![:\w]):([A-Za-z_]\w*)")
_QUIET = re.compile(r"'(?:[^'\\]|\\.)*'|--[^\n]*", re.S)


def statement(name: str, folder: str | Path = STATEMENTS) -> str:
    """Text of the statement ``name``."""
    return (Path(folder) / f"{name}.sql").read_text(encoding="utf-8")


def markers(text: str) -> set[str]:
    """Names of the parameter markers outside quotes and comments."""
    return set(_MARKER.findall(_QUIET.sub(" ", text)))


def run_sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    args = args or {}
    wanted = markers(text)
    if wanted != set(args):
        raise ValueError(f"markers without value: {sorted(wanted - set(args))}; values without marker: {sorted(set(args) - wanted)}")
    return spark.sql(text, args=args or None)


def run_statement(spark: SparkSession, name: str, folder: str | Path = STATEMENTS, **args) -> DataFrame:
    return run_sql(spark, statement(name, folder), args)
