"""Run time stamps as literals.

Every "now" of a run comes from one run stamp, so results are repeatable and
comparable; nothing calls ``current_timestamp()`` inside an operator.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT_PY = "%Y%m%d%H%M%S"
STAMP_FORMAT = "yyyyMMddHHmmss"


def new_stamp(now: datetime | None = None) -> str:
    """14-digit batch folder stamp."""
    return (now or datetime.now(timezone.utc).replace(tzinfo=None)).strftime(STAMP_FORMAT_PY)


def stamp_to_text(stamp: str) -> str:
    return datetime.strptime(stamp, STAMP_FORMAT_PY).strftime("%Y-%m-%d %H:%M:%S")


def ts_literal(text: str) -> Column:
    """Zone-less time stamp literal from ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.lit(text).cast("timestamp_ntz")


def parse_stamp(stamp: str) -> Column:
    """PARSE_TIMESTAMP('%Y%m%d%H%M%S', stamp) as a zone-less time stamp."""
    return F.to_timestamp_ntz(F.lit(stamp), F.lit(STAMP_FORMAT))
