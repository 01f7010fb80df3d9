"""Removal of repeated word sequences by seed and extend.

Seeds are winnowed anchors (``windows``): documents meet where they share the
anchor gram of a 20-word window. From the seed every match is extended both
ways: prefix hashes of the words to the left and to the right of the anchor
tell, for each way to divide 20 words between both sides, which members of the
group still agree. A whole group is extended at once, by grouping its members
on these hashes, instead of pair by pair. Of the members that agree on a
window, the first (smallest document, then start) keeps it and the others lose
it; neighbouring windows join up to the maximal repeats.

Defined results: null text has no words; fewer than 20 words have no window;
rows that share an id, or have none, are documents of their own, in the order
of their text. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textops
from ledgerline.llm import windows as win
from ledgerline.llm.common import id_and_text, ship_package, text_or_empty, with_row_id

WIDTH, GRAM = 20, 6


def solve(rows: list[dict]) -> list[list[tuple[int, int]]]:
    """Windows of each item that an earlier item of its group holds too."""
    lengths = np.array([len(r["units"]) // 8 for r in rows])
    words = np.frombuffer(b"".join(r["units"] for r in rows), np.uint64)
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    prefix = textops.Prefix(words)
    n = np.array([r["n"] for r in rows])
    item = np.repeat(np.arange(len(rows)), n)
    at = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
    begin = first[item] + at
    # the stretch left and right of the middle, extended to 20 words in all
    left, right = prefix.span(begin, begin + WIDTH // 2), prefix.span(begin + WIDTH // 2, begin + WIDTH)
    group = np.repeat(np.cumsum([i > 0 and r["key"] != rows[i - 1]["key"] for i, r in enumerate(rows)]), n)
    rid = np.array([r["rid"] for r in rows])[item]
    start = np.array([r["start"] for r in rows])[item] + at
    order = np.lexsort((start, rid, right, left, group))
    same = np.zeros(len(item), bool)
    g, a, b = group[order], left[order], right[order]
    same[1:] = (g[1:] == g[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    later = np.zeros(len(item), bool)
    later[order] = same
    out: list[list[tuple[int, int]]] = [[] for _ in rows]
    where = np.flatnonzero(later)
    for i, group_ in groupby(where.tolist(), key=lambda w: int(item[w])):
        places = [int(at[w]) for w in group_]
        cut = [0, *(k for k in range(1, len(places)) if places[k] != places[k - 1] + 1), len(places)]
        out[i] = [(places[x], y - x) for x, y in zip(cut, cut[1:], strict=False) if y > x]
    return out


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _remove(with_text: bool):
    kinds = [pa.int64()] * 3 + [pa.string()] * 2
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, spans in win.texts_of(batch):
                words = text.split()
                n = len(words)
                if spans is not None:
                    gone = win.covered(spans, WIDTH, n)
                    words = [words[i] for i in np.flatnonzero(~gone)]
                kept = b" ".join(words)
                out.append((doc, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            cols = zip(*out, strict=True) if out else [[]] * 5
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document (ids are whole numbers): doc_id, n_words, n_removed, kept_sha256, kept."""
    ship_package(docs.sparkSession)
    keyed = with_row_id(id_and_text(docs, id_col, text_col), "id", "text", "rid")
    texts = keyed.select("rid", text_or_empty("text").alias("text"))
    found = win.repeated_windows(texts, win.Spec(WIDTH, GRAM, win.word_units, win.word_values, True), solve)
    base = keyed.select("rid", F.col("id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return win.per_text(base, found).mapInArrow(_remove(with_text), RESULT)
