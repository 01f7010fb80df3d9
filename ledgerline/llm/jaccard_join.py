"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles. All shingles have one
order, rare before frequent (frequency classes from a fixed number of hashed
counters over all documents), then by hash. Two documents that link share at
least ``m`` shingles of their ``m``-prefixes, the first ``n - ceil(t*n) + m``
shingles. Each document picks its own ``m``: the higher the estimated number of
candidates its prefix brings, the longer the prefix and the more shared
prefix shingles are asked for before a pair is verified (the smaller ``m`` of
the two counts, which is what the shorter prefix guarantees). ``m`` is at most
``ceil(t*n)``, the least overlap of a document that links.

Documents with equal sets are one class from the start. Candidates are paired
inside the posting list of a prefix shingle; lists longer than ``BLOCK_ROWS``
are dealt out as pairs of blocks, so no task gets a whole hot list. A pair is
dropped if its sizes, or the L1 distance of two vectors of hashed counts (a
lower bound of the symmetric difference), rule a link out. The work comes in
rounds: neighbours in the lists are verified first and give components; then,
``NEAREST_ROUNDS`` times, each document's likeliest of another component; then
every remaining candidate pair *between different components* is verified.
So groups of near copies are joined without forming all their pairs, and no
link between components is lost.

Defined results: null text, or text without words, is an empty set that links
with nothing; fewer words than a shingle make one shingle; rows that share an
id, or have none, are documents of their own; a component is named by its
smallest id. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import textops
from ledgerline.llm.common import checkpoint, identified, partitions, ship_package, text_or_empty, written

COUNTERS = 1 << 16
#: Hashed counts per document, and how many more a document of WIDE_FROM
#: shingles on has; the wide vector folds into the narrow one.
CELLS, WIDE_CELLS, WIDE_FROM = 64, 256, 2000
#: Rows of a posting list that meet in one task.
BLOCK_ROWS = 4096
#: Rounds in which a document names one candidate a list, before all are paired.
NEAREST_ROUNDS = 2
#: Estimated candidates beyond which the prefix grows by one more match.
COSTS = (64, 512, 4096, 32768)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int):
    """Sorted distinct shingle hashes of all texts, and their offsets."""
    h, woffs, _, _ = textops.word_hashes(data, offs, lower=True)
    docs = len(offs) - 1
    sizes = np.diff(woffs)
    prefix = textops.Prefix(h)
    n = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(docs), n)
    start = np.repeat(woffs[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    length = np.minimum(sizes, k)[doc]
    grams = textops.mix(prefix.span(start, start + length) + length.astype(np.uint64))
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[new], grams[new]
    return grams, np.searchsorted(doc, np.arange(docs + 1))


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def _profile(k: int):
    """Set sizes and set hashes of the texts, and the counters of a task."""
    names = "rid n h1 h2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, offs, data in textops.blocks(batch.column(1)):
                grams, soffs = shingle_sets(data, offs, k)
                counts += np.bincount((grams >> np.uint64(48)).astype(np.int64), minlength=COUNTERS)
                h1 = textops.mix(_sums(grams, soffs)).view(np.int64)
                h2 = textops.mix(_sums(grams * (grams | np.uint64(1)), soffs)).view(np.int64)
                yield _batch(names, rids[first:first + len(offs) - 1], np.diff(soffs), h1, h2)
        used = np.flatnonzero(counts)  # counters come as rows without a set size
        yield _batch(names, used, np.full(len(used), -1), counts[used], np.zeros(len(used), np.int64))
    return run


def _classes(counts: np.ndarray) -> np.ndarray:
    """Frequency class of each counter: how far above the usual load it is."""
    usual = max(1.0, float(np.median(counts)))
    return np.floor(np.log2(np.maximum(1.0, counts / usual))).astype(np.uint64)


def _postings(k: int, percent: int, counts: np.ndarray):
    """Rows (token, rid, n, m) of every document's prefix."""
    classes, usual = _classes(counts), float(np.median(counts))
    noise = 4 * np.sqrt(usual + 1)
    excess = np.maximum(0.0, counts - usual - noise)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, offs, data in textops.blocks(batch.column(1)):
                grams, soffs = shingle_sets(data, offs, k)
                n = np.diff(soffs)
                doc = np.repeat(np.arange(len(n)), n)
                cell = (grams >> np.uint64(48)).astype(np.int64)
                token = (classes[cell] << np.uint64(58)) | (grams >> np.uint64(6))
                order = np.lexsort((token, doc))
                token, cost = token[order], excess[cell[order]]
                place = np.arange(len(token)) - soffs[:-1][doc]
                least = n - (percent * n + 99) // 100 + 1
                inside = place < least[doc]
                guess = np.bincount(doc[inside], cost[inside], minlength=len(n))
                m = 1 + np.searchsorted(np.array(COSTS, float), guess, "right")
                m = np.minimum(m, np.maximum(1, (percent * n + 99) // 100))  # a linked pair need not share more
                take = place < (least + m - 1)[doc]
                d = doc[take]
                yield _batch("token rid n m", token[take].view(np.int64), rids[first + d], n[d], m[d])
    return run


def _cells(k: int):
    """(rid, cells): the vector of hashed counts of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, offs, data in textops.blocks(batch.column(1)):
                grams, soffs = shingle_sets(data, offs, k)
                docs, n = len(offs) - 1, np.diff(soffs)
                doc = np.repeat(np.arange(docs), n)
                at = doc * WIDE_CELLS + (grams % np.uint64(WIDE_CELLS)).astype(np.int64)
                wide = np.bincount(at, minlength=docs * WIDE_CELLS).reshape(docs, WIDE_CELLS)
                narrow = np.minimum(_fold(wide), 255).astype(np.uint8)
                wide = np.minimum(wide, 255).astype(np.uint8)
                cells = [(wide if n[i] >= WIDE_FROM else narrow)[i].tobytes() for i in range(docs)]
                yield _batch("rid cells", rids[first:first + docs], pa.array(cells, pa.binary()))
    return run


def _fold(wide: np.ndarray) -> np.ndarray:
    return wide.reshape(len(wide), WIDE_CELLS // CELLS, CELLS).sum(1)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (rid, text) compressed, for a join that moves them."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield _batch("rid text", batch.column(0), pa.array([squeeze(t.as_py().encode()) for t in batch.column(1)], pa.binary()))


def _sets(k: int):
    """(rid, shingles) of compressed texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = pa.array([unpack(t.as_py()) for t in batch.column(1)], pa.binary())
            for first, offs, data in textops.blocks(texts):
                grams, soffs = shingle_sets(data, offs, k)
                sets = [grams[a:b].tobytes() for a, b in zip(soffs[:-1], soffs[1:], strict=True)]
                yield _batch("rid shingles", rids[first:first + len(sets)], pa.array(sets, pa.binary()))
    return run


def _pairs(percent: int, max_lag: int | None, nearest: bool = False):
    """Candidate pairs inside the groups of sorted rows (token, i, j, block,
    rid, n, m, comp, cells): (a, b, need, distance). With ``max_lag``, pairs of
    members further apart give only a row (rid, -1, ...) for each member. With ``nearest``,
    each later member gives its nearest earlier one alone."""
    def pairs(t: pa.Table):
        col = {c: t.column(c).to_numpy(zero_copy_only=False) for c in ("token", "i", "j", "block", "rid", "n", "m", "comp")}
        raw = [np.frombuffer(c, np.uint8) for c in t.column("cells").to_pylist()]
        wide = np.flatnonzero([len(c) == WIDE_CELLS for c in raw])
        wide_at = np.full(len(raw), -1)
        wide_at[wide] = np.arange(len(wide))
        wides = np.array([raw[i] for i in wide], np.int16).reshape(-1, WIDE_CELLS)
        cells = np.zeros((len(raw), CELLS), np.int16)
        small = np.flatnonzero(wide_at < 0)
        if len(small):
            cells[small] = np.concatenate([raw[i] for i in small]).reshape(-1, CELLS)
        cells[wide] = np.minimum(_fold(wides), 255)
        live, lag, further = np.arange(len(cells)), 1, np.zeros(len(cells), bool)
        least, first = np.full(len(cells), np.iinfo(np.int64).max), np.full(len(cells), -1)
        while len(live):
            live = live[live + lag < len(cells)]
            x, y = live, live + lag
            near = (col["token"][x] == col["token"][y]) & (col["i"][x] == col["i"][y]) & (col["j"][x] == col["j"][y])
            near &= 100 * col["n"][x] >= percent * col["n"][y]  # sorted by n: later ones are larger still
            live, x, y = live[near], x[near], y[near]
            ok = (col["comp"][x] != col["comp"][y]) & ((col["i"][x] == col["j"][x]) | (col["block"][x] != col["block"][y]))
            x, y = x[ok], y[ok]
            for a in range(0, len(x), 1 << 16):
                p, q = x[a:a + (1 << 16)], y[a:a + (1 << 16)]
                distance = np.abs(cells[p] - cells[q]).sum(1, dtype=np.int64)
                both = np.flatnonzero((wide_at[p] >= 0) & (wide_at[q] >= 0))
                if len(both):
                    distance[both] = np.abs(wides[wide_at[p[both]]] - wides[wide_at[q[both]]]).sum(1, dtype=np.int64)
                keep = (100 + percent) * distance <= (100 - percent) * (col["n"][p] + col["n"][q])
                p, q, distance = p[keep], q[keep], distance[keep]
                if not len(p):
                    continue
                if nearest:
                    nearer = distance < least[q]  # a lag has one p for each q
                    first[q[nearer]], least[q[nearer]] = p[nearer], distance[nearer]
                    continue
                if max_lag is not None and lag > max_lag:
                    further[p] = further[q] = True
                    continue
                yield _batch("a b need distance", col["rid"][p], col["rid"][q], np.minimum(col["m"][p], col["m"][q]).astype(np.int64), distance)
            lag += 1
        q = np.flatnonzero(first >= 0)
        if len(q):
            p = first[q]
            yield _batch("a b need distance", col["rid"][p], col["rid"][q], np.minimum(col["m"][p], col["m"][q]).astype(np.int64), least[q])
        if further.any():
            rid = np.unique(col["rid"][further])
            yield _batch("a b need distance", rid, np.full(len(rid), -1), np.zeros(len(rid), np.int64), np.zeros(len(rid), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < 50_000:
                continue
            t = pa.Table.from_batches(held)
            keys = [t.column(c).to_numpy(zero_copy_only=False) for c in ("token", "i", "j")]
            same = np.logical_and.reduce([x == x[-1] for x in keys])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield from pairs(t.slice(0, cut).combine_chunks())
                held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if held:
            yield from pairs(pa.Table.from_batches(held).combine_chunks())
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[r].as_py(), np.uint64)
                y = np.frombuffer(batch.column(3)[r].as_py(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                keep[r] = 100 * inter >= percent * (len(x) + len(y) - inter)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def components(links: DataFrame) -> DataFrame:
    """(rid, comp) of every row named in ``links`` (a, b): the smallest rid it
    reaches. Alternates large-star and small-star steps until nothing moves."""
    edges = checkpoint(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = checkpoint(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = checkpoint(small.unionByName(least.select("u", F.col("low").alias("v"))).where("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum("u"), F.sum("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy(F.col("u").alias("rid")).agg(F.min("v").alias("comp"))
        before = now


def _candidates(live: DataFrame, labels: DataFrame, percent: int, max_lag: int | None, nearest: bool = False) -> DataFrame:
    """Rows (a, b, need, distance) of the lists of ``live`` (token, rid, n, m, c),
    for the documents in ``labels`` (rid, cells, comp)."""
    rows = live.join(labels, "rid")
    rows = rows.withColumn("blocks", F.ceil(F.col("c") / BLOCK_ROWS).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                       "rid", "n", "m", "comp", "cells")
    dealt = rows.repartition(partitions(live), "token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "rid")
    return dealt.mapInArrow(textops.released(_pairs(percent, max_lag, nearest)), "a long, b long, need long, distance long")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of each b the two pairs of the least distance."""
    return pairs.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("distance", "a"))).where("r <= 2")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return checkpoint(both.mapInArrow(textops.released(_verify(percent)), "a long, b long"))


def join(docs: DataFrame, shingle: int = 3, percent: int = 90, id_col: str = "doc_id",
         text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Labels (rid, n_shingles, component_rid: the
    smallest rid of its component, component_id: that row's id), and ``docs`` as (rid, row)."""
    ship_package(docs.sparkSession)
    keyed = identified(docs, id_col, text_col)
    texts = keyed.select("rid", text_or_empty(F.col(f"row.`{text_col}`")).alias("text"))
    profile = written(texts.mapInArrow(textops.released(_profile(shingle)), "rid long, n long, h1 long, h2 long"))
    counts = np.zeros(COUNTERS, np.int64)
    for r in profile.where("n < 0").groupBy("rid").agg(F.sum("h1").alias("c")).collect():  # COUNTERS rows at most
        counts[r["rid"]] = r["c"]
    sizes = profile.where("n >= 0")
    firsts = checkpoint(sizes.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("rid").alias("rep"), F.count("*").alias("c")))

    postings = texts.mapInArrow(textops.released(_postings(shingle, percent, counts)), "token long, rid long, n long, m long")
    twice = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    live = written(postings.join(twice, "token").select("token", "rid", "n", "m", F.col("c").cast("int").alias("c")))
    copies = sizes.join(firsts.where("c > 1"), ["n", "h1", "h2"]).where("rid <> rep").select("rid")
    cells = texts.mapInArrow(textops.released(_cells(shingle)), "rid long, cells binary").join(copies, "rid", "left_anti")

    # round 1: list neighbours, of which each document tries its two likeliest;
    # documents with candidates further off in a list are named for round 2
    near = written(_candidates(live, cells.withColumn("comp", F.col("rid")), percent, 2).groupBy("a", "b").agg(
        F.min("distance").alias("distance")))
    named = near.select(F.col("a").alias("rid")).union(near.where("b >= 0").select("b")).distinct()
    sets = written(texts.mapInArrow(textops.released(_squeeze), "rid long, text binary").join(named, "rid", "left_semi")
                      .mapInArrow(textops.released(_sets(shingle)), "rid long, shingles binary"))
    links = _links(_likeliest(near.where("b >= 0")), sets, percent)
    comps = checkpoint(components(links))
    known = written(cells.join(named, "rid", "left_semi"))
    open_ = written(live.join(named, "rid", "left_semi"))

    def candidates(**options) -> DataFrame:
        """Candidates between different components."""
        labels = known.join(comps, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
        return _candidates(open_, labels, percent, None, **options)

    # the nearest of another component: most members of a group meet before all pairs are made
    for _ in range(NEAREST_ROUNDS):
        others = candidates(nearest=True).groupBy("a", "b").agg(F.min("distance").alias("distance"))
        links = links.unionByName(_links(_likeliest(others), sets, percent))
        comps = checkpoint(components(links))
    # last round: all candidates between different components
    rest = candidates().groupBy("a", "b").agg(
        F.min("need").alias("need"), F.count("*").alias("shared")).where("shared >= need")
    links = links.unionByName(_links(rest, sets, percent))
    comps = checkpoint(components(links))

    labels = sizes.join(firsts.select("n", "h1", "h2", "rep"), ["n", "h1", "h2"], "left").select(
        "rid", "n", F.coalesce("rep", "rid").alias("rep"))
    labels = labels.join(comps.select(F.col("rid").alias("rep"), "comp"), "rep", "left").select(
        "rid", F.col("n").alias("n_shingles"), F.coalesce("comp", "rep").alias("component_rid"))
    ids = keyed.select(F.col("rid").alias("component_rid"), F.col(f"row.`{id_col}`").alias("component_id"))
    return labels.join(ids, "component_rid").select("rid", "n_shingles", "component_rid", "component_id"), keyed


def components_of(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    labels, keyed = join(docs, **options)
    id_col = options.get("id_col", "doc_id")
    return keyed.select("rid", F.col(f"row.`{id_col}`").alias("doc_id")).join(labels, "rid").select(
        "doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, **options) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with their columns."""
    labels, keyed = join(docs, shingle=shingle, percent=percent, **options)
    first = labels.where("rid = component_rid").select("rid")
    return keyed.join(first, "rid", "left_semi").select("row.*")
