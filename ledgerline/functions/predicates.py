"""Active-version filter and the three change tests.

Each change test returns one Column over pairs (old, new) with SQL
three-valued logic: a row counts as changed only when the result is TRUE.

* ``padded`` (psql): ``new <> COALESCE(old, pad)``; pad is ``''`` for text,
  0 for money. NULL -> 'b' is a change, 'a' -> NULL is not.
* ``hash`` (gcp): ``MD5(old) != MD5(new)``. Equal text has equal digests, so
  this is ``old != new`` on the values (NULL on either side: no change).
  Values are compared, not their text, so decimal(10,2) 999.99 equals
  decimal(38,9) 999.990000000. ``use_md5=True`` hashes text (X8): as it is
  written, where 999.99 and 999.990000000 differ, or with ``canonical=True``
  without the zeros a number's scale adds.
* ``nullsafe``: ``NOT (old <=> new)``; every difference, NULLs included.

``rounded`` gives the pairs with the new money value in the stored type
(``round_before_compare``): a price of three decimals is then no change
against its own stored rounding, which it is, each run, by default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_active") == F.lit(True))


def _pad_for(kind: str) -> Column:
    return F.lit(0).cast("decimal(10,2)") if kind == "money" else F.lit("")


def changed_padded(pairs: list[tuple[Column, Column, str]]) -> Column:
    """pairs: (old, new, kind) with kind 'text' | 'money' | 'time'."""
    terms = []
    for old, new, kind in pairs:
        if kind == "time":
            terms.append(new != old)
        else:
            terms.append(new != F.coalesce(old, _pad_for(kind)))
    return _any(terms)


def rounded(pairs: list[tuple[Column, Column, str]], stored: str) -> list[tuple[Column, Column, str]]:
    return [(old, new.cast(stored) if kind == "money" else new, kind) for old, new, kind in pairs]


def canonical_text(value: Column, kind: str) -> Column:
    """Text of a value; a number without trailing zeros of its scale."""
    text = value.cast("string")
    return F.regexp_replace(text, r"^(-?[0-9]+)(?:\.0*|(\.[0-9]*[1-9])0*)$", "$1$2") if kind == "money" else text


def changed_hash(pairs: list[tuple[Column, Column, str]], use_md5: bool = False, canonical: bool = False) -> Column:
    terms = []
    for old, new, kind in pairs:
        if use_md5:
            a, b = (canonical_text(v, kind) if canonical else v.cast("string") for v in (old, new))
            terms.append(F.md5(a) != F.md5(b))
        else:
            terms.append(old != new)
    return _any(terms)


def changed_nullsafe(pairs: list[tuple[Column, Column, str]]) -> Column:
    return _any([~old.eqNullSafe(new) for old, new, _kind in pairs])


RULES = {"padded": changed_padded, "hash": changed_hash, "nullsafe": changed_nullsafe}


def change_predicate(rule: str, pairs: list[tuple[Column, Column, str]]) -> Column:
    return RULES[rule](pairs)


def _any(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out | t
    return out
