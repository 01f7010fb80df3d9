"""Equal windows across documents, found by content-defined partitioning.

Both repeat removers ask for every window of ``width`` units (bytes or words)
whose content stands elsewhere too. A window's anchor is the leftmost smallest
hash among its ``gram``-unit grams (winnowing), so equal windows have equal
anchors at equal distances. Consecutive windows that share one anchor form a
run; runs are grouped by the anchor gram, and equal windows can only be in one
group. So:

1. anchors that stand in one run only are dropped after a count per anchor
   (added up before the shuffle);
2. runs equal in content are one item with a first member; every other member
   is repeated as a whole;
3. items of an anchor with several different items go to a ``solver``, which
   gets whole groups of one task's share and names the repeated windows of each
   item's first member;
4. a group of more than ``GROUP_ITEMS`` different items is split: its runs are
   cut into shorter classes of neighbouring windows and grouped by the hash of
   all that the windows of a class have in common, which is longer than the
   gram; with one window per class all members are equal, so this ends.

Texts are joined once, compressed, to cut out the items; splitting works on the
items. Runs are found again for each use rather than kept, as they are as
bulky as the texts.

Result: (rid, spans) with spans of repeated windows as (start, windows).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textops
from ledgerline.llm.common import partitions, written

#: Different runs of one anchor that a task takes; larger groups are split.
GROUP_ITEMS = 1024
#: Windows a class when a group is split, one level after the other.
CLASSES = (16, 1)
#: Parts of a join's rows; a key that holds more than one part is dealt over several tasks.
SHARES = 1024
#: Units handled at once inside one text.
PIECE_UNITS = 1 << 22
#: Bytes of item texts a solver call takes, plus one group.
SOLVER_BYTES = 1 << 20

#: A run: ``place`` packs start, windows and the anchor's distance (lead); in
#: a split group ``src`` is the start of the item that the run is cut from.
RUN = "key long, item long, rid long, place long"
SPLIT = f"{RUN}, src long, weight long"
ITEM = "key long, item long, rid long, place long, copies long, kinds long, units binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _pack(start, n, lead):
    return (start << 20) | (n << 10) | lead


def _unpack(place):
    return place >> 20, (place >> 10) & 1023, place & 1023


START, WINDOWS = "shiftright(place, 20)", "shiftright(place, 10) & 1023"


class Spec(NamedTuple):
    """``units(data, offs)`` gives the unit values, the unit offsets of the
    texts and the units as stored in items; ``values`` maps stored units to
    values. Widths up to 1023 fit the packed places."""
    width: int
    gram: int
    units: Callable
    values: Callable
    keep_first: bool  # the first occurrence isn't marked


def byte_units(data: np.ndarray, offs: np.ndarray):
    return textops.BYTE_VALUES[data], offs, data


def byte_values(raw: bytes) -> np.ndarray:
    return textops.BYTE_VALUES[np.frombuffer(raw, np.uint8)]


def word_values(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def word_units(data: np.ndarray, offs: np.ndarray):
    h, woffs, _, _ = textops.word_hashes(data, offs, lower=False)
    return h, woffs, h


def _runs(values: np.ndarray, offs: np.ndarray, spec: Spec):
    """(text, start in text, windows, lead, key, item) of the runs of a block."""
    n_units, width = len(values), spec.width
    if n_units < width:
        return None
    if n_units > PIECE_UNITS + width and len(offs) == 2:  # one very long text, by pieces
        parts = [_runs(values[a:a + PIECE_UNITS + width - 1], np.array([0, min(PIECE_UNITS + width - 1, n_units - a)]), spec)
                 for a in range(0, n_units - width + 1, PIECE_UNITS)]
        for i, p in enumerate(parts):
            p[1][:] += i * PIECE_UNITS
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    prefix = textops.Prefix(values)
    grams = textops.mix(prefix.grams(spec.gram))
    mask = np.uint64((1 << 23) - 1)
    low = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    w, size = width - spec.gram + 1, 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:len(low) - (w - size)], low[w - size:]) if w > size else low
    anchor = (low & mask).astype(np.int64)
    begins, ends = offs[:-1], offs[1:] - width + 1
    whole = ends > begins
    steps = np.zeros(len(anchor) + 1, np.int32)
    np.add.at(steps, begins[whole], 1)
    np.add.at(steps, ends[whole], -1)
    at = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
    if not len(at):
        return None
    fresh = np.ones(len(at), bool)
    fresh[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (np.diff(at) > 1)
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(at)))
    start = at[first]
    lead = anchor[start] - start
    text = np.searchsorted(offs, start, "right") - 1
    item = textops.mix(prefix.span(start, start + n + width - 1) + (n * 4096 + lead).astype(np.uint64))
    return text, start - offs[text], n, lead, grams[anchor[start]].view(np.int64), item.view(np.int64)


def _find_runs(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, offs, data in textops.blocks(batch.column(1)):
                values, uoffs, _ = spec.units(data, offs)
                found = _runs(values, np.asarray(uoffs, np.int64), spec)
                if found is not None:
                    text, start, n, lead, key, item = found
                    yield pa.record_batch([pa.array(x) for x in (key, item, rids[first + text], _pack(start, n, lead))], _names(RUN))
    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the last column (texts), for a join that moves them."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        last = batch.num_columns - 1
        packed = pa.array([squeeze((t.as_py() or "").encode()) for t in batch.column(last)], pa.binary())
        yield pa.record_batch([*batch.columns[:last], packed], batch.schema.names)


def _cut_items(spec: Spec):
    """Rows (rid, text, wanted) to items with their units, compressed."""
    def run(batches):
        unpack, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out, size = [], 0
            for rid, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data = np.frombuffer(unpack(text.as_py()), np.uint8)
                raw = spec.units(data, np.array([0, len(data)]))[2]
                for x in wanted.as_py():
                    start, n, _ = _unpack(x["place"])
                    units = squeeze(raw[start:start + n + spec.width - 1].tobytes())
                    out.append((x["key"], x["item"], rid, x["place"], x["copies"], x["kinds"], units))
                    size += len(units)
                if size > SOLVER_BYTES:
                    yield _rows(out, ITEM)
                    out, size = [], 0
            if out:
                yield _rows(out, ITEM)
    return run


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [pa.binary() if c.endswith("binary") else pa.int64() for c in schema.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _names(schema))


def _classes(place: int, values: np.ndarray, key: int, spec: Spec, windows: int):
    """(key, item, place) of the shorter runs that an item is cut into."""
    start, n, lead = _unpack(place)
    prefix, anchor = textops.Prefix(values), start + lead
    i = np.arange(start, start + n)
    classes = (anchor - i) // windows
    for c in np.unique(classes):
        own = i[classes == c]
        a, m = int(own[0]), len(own)
        # all windows of the class hold these units, wherever the run is cut
        lo, hi = max(anchor - (c + 1) * windows + windows, start), min(anchor - (c + 1) * windows + 1 + spec.width, start + len(values))
        common = prefix.span(np.array([lo - start]), np.array([hi - start]))[0] + np.uint64(c) * textops.BASE + np.uint64(key & 0xFFFFFFFF)
        item = prefix.span(np.array([a - start]), np.array([a - start + m + spec.width - 1]))[0] + np.uint64(m * 4096 + anchor - a)
        h = textops.mix(np.array([common, item])).view(np.int64)
        yield int(h[0]), int(h[1]), _pack(a, m, anchor - a)


def _split_items(spec: Spec, windows: int):
    """Items of large groups to shorter runs, ``windows`` windows a class."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                start, _, _ = _unpack(r["place"])
                for key, item, place in _classes(r["place"], spec.values(unpack(r["units"])), r["key"], spec, windows):
                    out.append((key, item, r["rid"], place, start, r["copies"]))
                if len(out) > 20_000:
                    yield _rows(out, SPLIT)
                    out = []
            if out:
                yield _rows(out, SPLIT)
    return run


def _cut_again(spec: Spec, unit_bytes: int):
    """Rows (rid, units, start of the item, wanted) to shorter items."""
    def run(batches):
        unpack, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                units = unpack(r["units"])
                for x in r["wanted"]:
                    start, n, _ = _unpack(x["place"])
                    a = (start - r["src"]) * unit_bytes
                    part = units[a:a + (n + spec.width - 1) * unit_bytes]
                    out.append((x["key"], x["item"], r["rid"], x["place"], x["copies"], x["kinds"], squeeze(part)))
            if out:
                yield _rows(out, ITEM)
    return run


def _groups(solver: Callable):
    """Feeds whole groups of about SOLVER_BYTES to ``solver(rows)``, which gives
    the repeated (offset, windows) of each row's item."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[dict] = []

        def solve(rows):
            found = solver(rows)
            keep = [(r["rid"], r["start"] + a, n) for r, spans in zip(rows, found, strict=True) for a, n in spans]
            if keep:
                return _rows(keep, "rid long, start long, n long")

        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                if size > SOLVER_BYTES and held[-1]["key"] != r["key"]:
                    if (b := solve(held)) is not None:
                        yield b
                    held, size = [], 0
                r["start"], r["n"], _ = _unpack(r["place"])
                r["units"] = unpack(r["units"])
                held.append(r)
                size += len(r["units"])
        if held and (b := solve(held)) is not None:
            yield b
    return run


def _dealt(rows: DataFrame, table: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, a written table of one row per ``by`` that
    names in ``held`` how many of the rows it meets. A key that holds more than
    one of SHARES parts of them is dealt over as many tasks as it holds parts.
    There are fewer than SHARES such keys, hence the broadcast, and their rows
    of ``table`` become less than twice as many."""
    total = table.agg(F.sum("held")).first()[0] or 0
    share = max(1, -(-total // SHARES))
    hot = F.broadcast(table.where(F.col("held") > share).select(*by, F.ceil(F.col("held") / share).cast("int").alias("parts")))
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("rid", "place"), F.col("parts"))).cast("int")
    left = rows.join(hot, by, "left").withColumn("part", part).drop("parts")
    right = table.drop("held").join(hot, by, "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return left.join(right, [*by, "part"], how).drop("part")


def _items(runs: DataFrame, keep_first: bool) -> tuple[DataFrame, DataFrame]:
    """Distinct items of ``runs``, each with its first member's place and its
    copies; and the stretches that are repeated as a whole."""
    members = ["rid", "place", *(c for c in ("src",) if c in runs.columns)]
    items = runs.groupBy("key", "item").agg(F.min(F.struct("rid", "place")).alias("first"), F.sum("weight").alias("copies"),
                                            F.count("*").alias("members"), *(F.min_by(c, F.struct("rid", "place")).alias(c) for c in members[2:]))
    items = written(items.select("key", "item", "first.*", *members[2:], "copies", "members"))
    shared = items.where("members > 1").select("key", "item", F.col("rid").alias("r0"), F.col("place").alias("p0"), F.col("members").alias("held"))
    whole = _dealt(runs, shared, ["key", "item"]).where("rid <> r0 OR place <> p0").select("rid", "place")
    if not keep_first:
        whole = whole.unionByName(items.where("copies > 1").select("rid", "place"))
    return items, whole.select("rid", F.expr(START).alias("start"), F.expr(WINDOWS).alias("n"))


def _wanted(items: DataFrame, by: list[str]) -> DataFrame:
    """Per text the items whose key has several, with their number ``kinds``."""
    kinds = written(items.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    many = _dealt(items, kinds.withColumn("held", F.col("kinds")), ["key"])
    return many.groupBy(*by).agg(F.collect_list(F.struct("key", "item", "place", "copies", "kinds")).alias("wanted"))


def _live(runs: DataFrame, weight: str = "1") -> DataFrame:
    """Runs whose anchor stands in more than one, written as a table."""
    twice = written(runs.groupBy("key").agg(F.sum(F.expr(weight)).alias("c"), F.count("*").alias("held")).where("c > 1").select("key", "held"))
    return written(_dealt(runs, twice, ["key"], "left_semi"))


def repeated_windows(docs: DataFrame, spec: Spec, solver: Callable) -> DataFrame:
    """(rid, start, n): repeated windows of ``docs`` (rid, text); ``n`` windows
    from ``start``. Stretches may overlap or touch."""
    runs = _live(docs.mapInArrow(_find_runs(spec), RUN)).withColumn("weight", F.lit(1).cast("long"))
    items, found = _items(runs, spec.keep_first)
    texts = docs.mapInArrow(_squeeze, "rid long, text binary")
    cut = texts.join(_wanted(items, ["rid"]), "rid").select("rid", "text", "wanted").mapInArrow(_cut_items(spec), ITEM)
    unit_bytes = 8 if spec.values is word_values else 1
    for windows in (*CLASSES, 0):
        cut = written(cut)
        small = cut.where(F.col("kinds") <= GROUP_ITEMS) if windows else cut
        by_key = small.repartition(partitions(docs), "key").sortWithinPartitions("key", "item")
        found = found.unionByName(by_key.mapInArrow(_groups(solver), "rid long, start long, n long"))
        large = cut.where(F.col("kinds") > GROUP_ITEMS)
        if not windows or large.isEmpty():
            return found
        runs = _live(large.mapInArrow(_split_items(spec, windows), SPLIT), "weight")
        items, whole = _items(runs, spec.keep_first)
        found = found.unionByName(whole)
        source = large.select("rid", F.expr(START).alias("src"), "units")
        again = source.join(_wanted(items, ["rid", "src"]), ["rid", "src"]).select("rid", "src", "units", "wanted")
        cut = again.mapInArrow(_cut_again(spec, unit_bytes), ITEM)
    return found


def per_text(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every row of ``docs`` (rid, doc_id, text) with its text compressed and
    ``spans``: array of (start, n), or null."""
    spans = found.groupBy("rid").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return docs.mapInArrow(_squeeze, "rid long, doc_id long, text binary").join(spans, "rid", "left").select("doc_id", "text", "spans")


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(doc_id, text as bytes, spans or None) of the rows of ``per_text``."""
    unpack = zstandard.ZstdDecompressor().decompress
    for doc, text, spans in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
        yield doc.as_py(), unpack(text.as_py()), spans.as_py()


def covered(spans: list[dict] | None, width: int, n_units: int) -> np.ndarray:
    """Mask of the units inside the windows of ``spans``."""
    steps = np.zeros(n_units + 1, np.int32)
    if spans:
        a = np.array([s["start"] for s in spans])
        n = np.array([s["n"] for s in spans])
        np.add.at(steps, a, 1)
        np.add.at(steps, np.minimum(a + n + width - 1, n_units), -1)
    return np.cumsum(steps[:-1]) > 0
