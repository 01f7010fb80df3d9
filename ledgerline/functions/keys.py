"""U2 / U3 key expressions (U1, the sequence, is an operator)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(id_col: Column | str, stamp: str) -> Column:
    """Repeatable stand-in for a random UUID: md5 of ``id|stamp``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit("|"), F.lit(stamp)))


def random_key() -> Column:
    """Literal random UUID; must be written once before anything reads it."""
    return F.expr("uuid()")


def epoch_key(id_col: Column | str, run_ts: str) -> Column:
    """``<unix seconds of run>_<id>``; the zone-less run time counts as UTC
    whatever the session time zone (UNIX_SECONDS of the run instant)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    t = F.lit(run_ts).cast("timestamp_ntz")
    instant = F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
                               F.second(t), F.lit("UTC"))
    secs = F.unix_seconds(instant)
    return F.concat(secs.cast("string"), F.lit("_"), c.cast("string"))
