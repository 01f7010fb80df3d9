"""Removal of repeated byte strings with a run-length index.

Texts are cut into runs of 400-byte windows that share an anchor
(``windows``), so strings that can be equal meet in one group. Over the groups
of a task a run-length index is built: the Burrows-Wheeler transform of the
runs' texts, compressed to its runs, with the text position of each run's first
and last entry as samples. For these the match with the neighbouring suffix is
measured; for every other suffix it is that of the suffix one byte earlier less
one, because inside a run of the transform neighbours stay neighbours. So the
longest match of every position with any other one (its matching statistic)
streams from the samples alone, from left to right, and the windows whose match
reaches 400 bytes are marked. A repetitive group has few runs, so few samples.

Defined results: null text counts as empty; a text shorter than the width has
no window; rows with equal or null ids are documents of their own; equal texts
lose all that is covered by repeated windows, which is everything from 400
bytes on. Strings that repeat inside one document count as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import windows as win
from ledgerline.llm.common import id_and_text, ship_package, text_or_empty, with_row_id

WIDTH, GRAM = 400, 100


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array by doubling, and for each doubled length the rank of every
    suffix by that many bytes. Only suffixes that still tie are sorted again."""
    n = len(text)
    wide = np.zeros(n + 7, np.uint64)
    wide[:n] = text.astype(np.uint64) + np.uint64(1)
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = (key << np.uint64(9)) | wide[i:i + n]
    order = np.argsort(key)
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)  # place of the first suffix of the tie
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, length = [(7, rank.astype(np.int32))], 7
    while True:
        alone = fresh & np.append(fresh[1:], True)
        rows = np.flatnonzero(~alone)
        if not len(rows):
            return order, levels
        tied = order[rows]
        after = np.where(tied + length < n, rank[np.minimum(tied + length, n - 1)] + 1, 0)
        key = (rank[tied].astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        order[rows] = tied
        fresh[rows] = np.concatenate([[True], key[1:] != key[:-1]])
        rank[tied] = np.maximum.accumulate(np.where(fresh[rows], rows, 0))
        length *= 2
        levels.append((length, rank.astype(np.int32)))


def common_prefix(a: np.ndarray, b: np.ndarray, levels, text: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes a[i] and b[i]."""
    n = len(text)
    out = np.zeros(len(a), np.int64)
    for length, rank in reversed(levels):
        x, y = a + out, b + out
        inside = (x + length <= n) & (y + length <= n)
        out[inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])] += length
    going = np.ones(len(a), bool)
    for _ in range(6):  # less than one step of the shortest level is left
        x, y = a + out, b + out
        going &= (x < n) & (y < n)
        going &= text[np.where(going, x, 0)] == text[np.where(going, y, 0)]
        out[going] += 1
    return out


class RunLengthIndex:
    """Run-compressed transform of a text with sampled run ends."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        order, levels = suffix_order(text)
        bwt = text[order - 1].astype(np.int16)  # the byte before each suffix
        bwt[order == 0] = 256
        new = np.ones(self.n, bool)
        new[1:] = bwt[1:] != bwt[:-1]
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], self.n) - 1
        self.letters, self.lengths = bwt[heads], tails - heads + 1
        # samples: text position and match with the suffix before / after it in order
        self.heads, self.head_match = self._sample(text, order, heads, heads - 1, levels)
        self.tails, self.tail_match = self._sample(text, order, tails, tails + 1, levels)

    def _sample(self, text, order, rows, others, levels):
        ok = (others >= 0) & (others < self.n)
        match = np.zeros(len(rows), np.int64)
        match[ok] = common_prefix(order[rows[ok]], order[others[ok]], levels, text)
        at = order[rows]
        by = np.argsort(at)
        return at[by], match[by]

    def matching_statistics(self) -> np.ndarray:
        """Longest match of every text position with another one, streamed from
        the samples: one less than at the position before, unless sampled."""
        out = np.zeros(self.n, np.int64)
        place = np.arange(self.n)
        for at, match in ((self.heads, self.head_match), (self.tails, self.tail_match)):
            last = np.searchsorted(at, place, "right") - 1
            known = last >= 0
            value = np.zeros(self.n, np.int64)
            value[known] = match[last[known]] - (place[known] - at[last[known]])
            np.maximum(out, value, out=out)
        return out


def solve(rows: list[dict]) -> list[list[tuple[int, int]]]:
    """Repeated windows of each item; items that have copies are marked already."""
    parts, starts, at = [], [], 0
    for r in rows:
        units = np.frombuffer(r["units"], np.uint8)
        parts += [units, np.array([255], np.uint8)]  # no UTF-8 text holds this byte
        starts.append(at)
        at += len(units) + 1
    if not parts:
        return []
    match = RunLengthIndex(np.concatenate(parts)).matching_statistics()
    out = []
    for r, a in zip(rows, starts, strict=True):
        if r["copies"] > 1:
            out.append([])
            continue
        hit = np.concatenate([[0], (match[a:a + r["n"]] >= WIDTH).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(hit))
        out.append([(int(x), int(y - x)) for x, y in zip(edge[::2], edge[1::2], strict=True)])
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _remove(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, data, spans in win.texts_of(batch):
                if spans is None:
                    out.append((doc, len(data), 0, 0, hashlib.sha256(data).hexdigest(), data.decode() if with_text else None))
                    continue
                gone = win.covered(spans, WIDTH, len(data))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                n_spans = int(gone[0]) + int((np.diff(gone.astype(np.int8)) == 1).sum()) if len(gone) else 0
                out.append((doc, len(data), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "replace") if with_text else None))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64()] * 4 + [pa.string()] * 2, strict=True)],
                                  [c.split()[0] for c in RESULT.split(", ")]) if out else pa.record_batch(
                [pa.array([], k) for k in [pa.int64()] * 4 + [pa.string()] * 2], [c.split()[0] for c in RESULT.split(", ")])
    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document (ids are whole numbers): doc_id, n_bytes, n_removed, n_spans, kept_sha256 and
    ``kept``, the remaining text (cut characters show as replacement marks)."""
    ship_package(docs.sparkSession)
    keyed = with_row_id(id_and_text(docs, id_col, text_col), "id", "text", "rid")
    texts = keyed.select("rid", text_or_empty("text").alias("text"))
    found = win.repeated_windows(texts, win.Spec(WIDTH, GRAM, win.byte_units, win.byte_values, False), solve)
    base = keyed.select("rid", F.col("id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return win.per_text(base, found).mapInArrow(_remove(with_text), RESULT)
