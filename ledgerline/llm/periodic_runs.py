"""Periodic runs of words: string synchronising sets at dyadic scales.

A run is a stretch of consecutive words of one text with smallest period ``q``
(words ``q`` apart are identical) that no neighbouring word extends, at least
``EXPONENT * q`` and ``SHORTEST`` words long.

Method. At scale ``t`` (a power of two) a position is *synchronising* when the
least hash among the windows of ``t`` words that start in ``[i, i + t]`` stands
at ``i`` or ``i + t``; windows inside highly periodic regions (period up to
``t / 4``) take no part. The choice depends on the ``2 t`` words from ``i`` on
alone, so it is the same in every period of a run, and a run of period
``t <= q < 2 t`` holds one in each stretch of ``t`` words. Two neighbouring
synchronising positions with equal contexts of ``2 t`` words lie exactly one
period apart; each such pair proposes its distance, and the stretch is extended
both ways by prefix hashes. Periods below ``SMALLEST_SCALE``, which the sets
omit, come from comparing the text with itself shifted; these regions and the
runs of smaller scales are the highly periodic ones of the scales above.

Everything is vectorised over blocks of whole texts, in time n log^2 n. Texts
stay where they are read: no shuffle. Words and stretches are compared by
64-bit hashes.

Defined results: a null, empty or blank text has no words and no runs; each
input row gives one result row, so repeated rows, null ids and extra columns
(under any name) come back as often as they went in. Of equally good best runs
the one with the smallest start, then period, is named.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import textops as tx
from ledgerline.llm.common import ship_package, text_or_empty

EXPONENT = 4
SHORTEST = 6
SMALLEST_SCALE = 8

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _longest_match(prefix: tx.Prefix, a: np.ndarray, b: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
    """Most units, up to ``room``, that agree from a and b on (``back``: before them)."""
    out = np.zeros(len(a), np.int64)
    step = 1 << max(int(room.max(initial=0)), 1).bit_length()
    while step:
        n = out + step
        ok = np.flatnonzero(n <= room)
        x, y, n = a[ok], b[ok], n[ok]
        same = prefix.span(x - n, x) == prefix.span(y - n, y) if back else prefix.span(x, x + n) == prefix.span(y, y + n)
        out[ok[same]] += step
        step >>= 1
    return out


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i:i + width] for every i (shorter at the end)."""
    least, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        least[:-step] = np.minimum(least[:-step], least[step:])
        have += step
    return least


def _marked(size: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Flags of the positions inside any [start, stop)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, stop, -1)
    return np.cumsum(change[:-1]) > 0


def _small_periods(ids: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Stretches (start, stop, period) of periods below the smallest scale."""
    found: list[np.ndarray] = []
    for q in range(1, SMALLEST_SCALE):
        if len(ids) <= q:
            break
        same = (ids[q:] == ids[:-q]) & (np.arange(q, len(ids)) < ends[:-q])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        start, stop = edge[::2], edge[1::2] + q
        fit = stop - start >= max(SHORTEST, EXPONENT * q)
        mine = np.column_stack([start[fit], stop[fit], np.full(int(fit.sum()), q)])
        for past in found:  # a stretch whose smallest period divides q is found already
            if q % past[0, 2] == 0:
                known = {(int(s), int(e)) for s, e, _ in past}
                mine = mine[[(int(s), int(e)) not in known for s, e, _ in mine]]
            if not len(mine):
                break
        if len(mine):
            found.append(mine)
    return found


def _at_scale(t: int, ids: np.ndarray, ends: np.ndarray, periodic: np.ndarray) -> np.ndarray:
    """Stretches (start, stop, period) with t <= period < 2 t. ``periodic`` are
    the runs of smaller periods in the same places."""
    prefix = tx.Prefix(ids)
    names = tx.mix(prefix.grams(t)) | np.uint64(1)
    names = np.concatenate([names, np.full(len(ids) - len(names), ~np.uint64(0))])
    place = np.arange(len(ids))
    none = ~np.uint64(0)
    names[place + t > ends] = none
    inside = periodic[(4 * periodic[:, 2] <= t) & (periodic[:, 1] - periodic[:, 0] >= t)]
    names[_marked(len(ids), inside[:, 0], inside[:, 1] - t + 1)] = none
    least = _window_min(names, t + 1)
    at = place[(place + 2 * t <= ends) & (least != none)]
    at = at[(least[at] == names[at]) | (least[at] == names[at + t])]
    if len(at) < 2:
        return np.zeros((0, 3), np.int64)
    context = tx.mix(prefix.span(at, at + 2 * t)) ^ tx.mix(ends[at].astype(np.uint64))
    by = np.argsort(context, kind="stable")
    at, context = at[by], context[by]
    gap = np.diff(at)
    pair = np.flatnonzero((context[1:] == context[:-1]) & (gap >= t) & (gap < 2 * t))
    a, q = at[pair], gap[pair]
    first = np.searchsorted(ends, ends[a])  # ends repeat inside a text: its first place
    right = _longest_match(prefix, a, a + q, ends[a] - a - q, False)
    left = _longest_match(prefix, a, a + q, a - first, True)
    start, stop = a - left, a + q + right
    fit = stop - start >= np.maximum(SHORTEST, EXPONENT * q)
    return np.unique(np.column_stack([start, stop, q])[fit], axis=0)


def runs_of(ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Runs of the texts ``ids[offs[k]:offs[k + 1]]`` as rows (start, stop,
    period), places counted over the whole block, by start, then period."""
    ends = np.repeat(offs[1:], np.diff(offs))
    found = _small_periods(ids, ends)
    sizes, t = np.diff(offs), SMALLEST_SCALE
    live = np.arange(len(sizes))
    while True:
        live = live[sizes[live] >= EXPONENT * t]
        if not len(live):
            break
        # only the texts that are long enough for this scale, side by side
        keep = np.repeat(np.isin(np.arange(len(sizes)), live), sizes)
        where = np.flatnonzero(keep)
        stops = np.cumsum(sizes[live])
        known = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        known = known[keep[known[:, 0]]]
        back = np.cumsum(keep) - 1
        local = np.column_stack([back[known[:, 0]], back[known[:, 1] - 1] + 1, known[:, 2]])
        new = _at_scale(t, ids[where], np.repeat(stops, sizes[live]), local)
        if len(new):
            found.append(np.column_stack([where[new[:, 0]], where[new[:, 1] - 1] + 1, new[:, 2]]))
        t *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _found(with_text: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offs, data in tx.blocks(batch.column(1)):
                ids, woffs, begins, stops = tx.word_hashes(data, offs, lower=False)
                runs = runs_of(ids, woffs)
                owner = np.searchsorted(woffs, runs[:, 0], "right") - 1
                cut = np.searchsorted(owner, np.arange(len(woffs)))
                dropped = _marked(len(ids), runs[:, 0] + runs[:, 2], runs[:, 1])
                raw = data.tobytes()
                rows, n = [], len(offs) - 1
                for k in range(n):
                    a, b = int(woffs[k]), int(woffs[k + 1])
                    mine = [(int(s) - a, int(e - s), int(q)) for s, e, q in runs[cut[k]:cut[k + 1]]]
                    best = max(mine, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                    text = None
                    if with_text:
                        text = b" ".join([raw[begins[i]:stops[i]] for i in range(a, b) if not dropped[i]]).decode()
                    rows.append((b - a, [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine],
                                 None if best is None else dict(zip(("start", "length", "period"), best, strict=True)),
                                 int(dropped[a:b].sum()), text))
                cols = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *cols], schema=schema)
    return run


def find(docs: DataFrame, text_col: str = "text", with_text: bool = True, keep: list[str] | None = None) -> DataFrame:
    """One row per document: the struct ``row`` of its columns (``keep``: only
    those), ``n_words``, ``runs`` (array of start, length, period by start, then
    period), ``best`` (the run of greatest length / period), ``n_dropped`` and
    ``collapsed``, the text without the words that any run holds after its
    first period, joined by one blank (null without ``with_text``)."""
    ship_package(docs.sparkSession)
    carried = [c for c in docs.columns if keep is None or c in keep]
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), text_or_empty(text_col).alias("text"))
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    out = T.StructType([df.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run_type)),
                        T.StructField("best", run_type), T.StructField("n_dropped", T.LongType()), T.StructField("collapsed", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema
    return df.mapInArrow(_found(with_text, to_arrow_schema(out)), out)


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the periods after the first cut from ``text_col``; a text
    without runs stays as it is, character for character."""
    found = find(docs, text_col)
    new = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col(f"row.`{text_col}`"))
    return found.select(*[(new if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
