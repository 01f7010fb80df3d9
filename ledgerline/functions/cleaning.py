"""Value cleaning of raw CSV text, as built-in column expressions.

Rule (per value): the literal text ``\\N`` becomes NULL; text made only of
ASCII digits with at most one dot (and at least one digit) becomes the
integer part of its float value, written back as text (``999.99`` -> ``999``,
``007`` -> ``7``, ``.5`` -> ``0``); anything else is kept unchanged.
Values past 2^53 lose precision exactly as a float round trip does; values
past the bigint range raise under ANSI casts (the one deviation: no unbounded
integers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The NULL marker and the "digits with at most one dot" pattern.
NULL_MARKER = "\\N"
NUMERIC_TEXT = r"^([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def clean_value(col: Column | str, truncate: bool = True) -> Column:
    v = F.col(col) if isinstance(col, str) else col
    if truncate:
        numeric = v.cast("double").cast("bigint").cast("string")
    else:
        numeric = v
    return (F.when(v == F.lit(NULL_MARKER), F.lit(None).cast("string"))
             .when(v.rlike(NUMERIC_TEXT), numeric)
             .otherwise(v))


def clean_values(df: DataFrame, cols: list[str] | None = None, truncate: bool = True,
                 keep_empty: bool = True) -> DataFrame:
    """Apply :func:`clean_value` to ``cols`` (default: every column).

    Columns must be text. ``keep_empty`` turns reader NULLs back into ``''``
    first, so an empty CSV field stays empty while ``\\N`` becomes NULL.
    """
    cols = list(df.columns) if cols is None else cols
    exprs = []
    for c in df.columns:
        if c in cols:
            v = F.coalesce(F.col(c), F.lit("")) if keep_empty else F.col(c)
            exprs.append(clean_value(v, truncate).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)
