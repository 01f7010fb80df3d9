"""Benchmark decontamination with a positional inverted index.

The words of the training documents are the index: postings (term, document,
position), of which only those of benchmark terms are ever kept. Every window
of a benchmark item (``window`` consecutive words; a shorter item is one
window) picks its rarest terms by their frequency in the training data, two more
than the places in which a near match may differ; their posting lists are
shifted by the term's place in the item, and where two of them meet in one
(document, item, shift) the item may be aligned there: any match of the window
has two of those terms in place. Only those alignments are compared word by
word, which gives the exact phrases, and as proximity matches the windows of
which at least ``near`` words, but not all, stand in their places.

A term that no document has is a place that differs; windows with more of them
than a near match allows are dropped at once. The benchmark's
terms are broadcast only if their bytes are within ``MAX_BROADCAST_BYTES``;
beyond that the same joins shuffle.

Defined results: null texts have no words; an item without words is ignored; a
null item id counts as the empty name; items that share an id count once; each
row of ``documents`` is judged by itself, so repeated rows give repeated
results. Ties in rarity go to the earlier place in the item. Places before the
first or after the last word of a document differ, so a proximity match may
start before it; an item of at most ``near`` words has exact matches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint, identified, lower_ascii, rows_where, text_or_empty

#: Everything but words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same on text whose A-Z are not lower-cased yet.
GAPS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, NEAR = 10, 8
#: Largest table of terms, in bytes, that is broadcast; a larger one is shuffled to the same joins.
MAX_BROADCAST_BYTES = 16 << 20


def words(text: Column, gaps: str = GAPS) -> Column:
    return F.filter(F.split(text, gaps), lambda w: w != "")


def _bounded(df: DataFrame) -> DataFrame:
    """A checkpointed table of terms, marked for broadcast if its bytes, summed
    first, are within the bound."""
    held = df.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    return F.broadcast(df) if held <= MAX_BROADCAST_BYTES else df


def pivots(items: DataFrame, frequency: DataFrame, window: int, near: int) -> DataFrame:
    """(item, q, term, need): the places of the rarest terms of each window, so
    many that every match of the window has ``need`` of them in place."""
    size = F.least(F.size("iwords"), F.lit(window))
    at = (items.select("item", "iwords", size.alias("len"), F.explode(
            F.sequence(F.lit(0), F.size("iwords") - size)).alias("s"))
          .select("item", "s", "len", F.posexplode(F.slice("iwords", F.col("s") + 1, F.col("len"))).alias("o", "term")))
    known = at.join(frequency, "term")
    per = Window.partitionBy("item", "s")
    # of the places that may differ, absent terms take theirs
    ranked = (known.withColumn("least", F.least(F.col("len"), F.lit(near)))
              .withColumn("spare", F.count("*").over(per) - F.col("least")).where("spare >= 0")
              .withColumn("need", F.least(F.col("least"), F.lit(2)))
              .withColumn("r", F.row_number().over(per.orderBy("freq", "o"))).where("r <= spare + need"))
    return ranked.select("item", (F.col("s") + F.col("o")).alias("q"), "term", "need").distinct()


def alignments(docs: DataFrame, items: DataFrame, window: int, near: int) -> DataFrame:
    """Per document (_rid) the array ``cands`` of (item_id, iwords, shift)."""
    text = lower_ascii(text_or_empty("_x"))
    vocabulary = checkpoint(items.select(F.explode("iwords").alias("term")).distinct())
    tokens = docs.select(F.explode(words(text)).alias("term"))
    frequency = tokens.join(_bounded(vocabulary), "term").groupBy("term").agg(F.count("*").alias("freq"))
    at = checkpoint(pivots(items, frequency, window, near))
    postings = docs.select("_rid", F.posexplode(words(text)).alias("pos", "term"))
    met = (postings.join(_bounded(at), "term")
           .select("_rid", "item", "need", (F.col("pos") - F.col("q")).alias("shift"))
           .groupBy("_rid", "item", "shift").agg(F.count("*").alias("n"), F.max("need").alias("need"))
           .where("n >= need"))
    return (met.join(items, "item").groupBy("_rid")
            .agg(F.collect_list(F.struct("item_id", "iwords", "shift")).alias("cands")))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int = NEAR,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """One row per document: ``row`` (all its columns), n_words, ``hits`` (array
    of item_id, start, length of the phrases found), n_hit, ``item_ids`` (sorted
    array), ``near`` (sorted array of item_id, start, same of the windows that
    nearly match), n_proximity (their number)."""
    keyed = identified(docs, id_col, text_col).select(F.col("rid").alias("_rid"), "row", F.col(f"row.`{text_col}`").alias("_x"))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
                             words(lower_ascii(text_or_empty(item_text))).alias("iwords"))
    # equal items of one id are one item; a number, fixed by the checkpoint, names the row
    items = checkpoint(items.where(F.size("iwords") > 0).distinct().withColumn("item", F.monotonically_increasing_id()))
    found = alignments(keyed.select("_rid", "_x"), items, window, near)
    joined = keyed.select("_rid", "row", text_or_empty("_x").alias("_x")).join(found, "_rid", "left")
    df = joined.select(
        "row", "cands", F.size(words(F.col("_x"), GAPS_ANY_CASE)).cast("long").alias("n_words"),
        F.when(F.col("cands").isNotNull(), words(lower_ascii(F.col("_x")))).alias("_w"))

    def in_place(c):
        equal = F.transform(c["iwords"], lambda w, q: F.coalesce(
            F.when(c["shift"] + q >= 0, F.get(F.col("_w"), c["shift"] + q)) == w, F.lit(False)).cast("int"))
        return F.struct(c["item_id"].alias("item_id"), c["shift"].alias("shift"), equal.alias("equal"))

    def enough(c):
        """Whether all windows together have the words in place that one needs."""
        return F.aggregate(c["equal"], F.lit(0), lambda a, x: a + x) >= F.least(F.size(c["equal"]), F.lit(window), F.lit(near))

    def compare(c):
        m = F.size(c["equal"])
        size = F.least(m, F.lit(window))
        sums = F.transform(F.sequence(F.lit(0), m - size), lambda s: F.struct(
            (c["shift"] + s).alias("start"), size.alias("length"),
            F.aggregate(F.slice(c["equal"], s + 1, size), F.lit(0), lambda a, x: a + x).alias("same")))
        return F.struct(c["item_id"].alias("item_id"), F.filter(sums, lambda x: x["same"] >= F.least(x["length"], F.lit(near))).alias("sums"))

    # a column used twice is computed once, and not inside the function
    df = df.withColumn("_c", F.when(F.size("_w") > 0, F.transform(F.filter(F.transform("cands", in_place), enough), compare)))
    df = df.withColumn("_p", F.filter(F.transform("_c", lambda c: F.struct(c["item_id"].alias("item_id"), F.filter(
        c["sums"], lambda x: x["same"] == x["length"]).alias("spans"))), lambda c: F.size(c["spans"]) > 0))
    spots = F.flatten(F.transform("_p", lambda c: F.flatten(F.transform(
        c["spans"], lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))
    hits = F.flatten(F.transform("_p", lambda c: F.transform(c["spans"], lambda s: F.struct(
        c["item_id"].alias("item_id"), s["start"].alias("start"), s["length"].alias("length")))))
    names = F.array_sort(F.array_distinct(F.transform("_p", lambda c: c["item_id"])))
    none = F.array().cast("array<struct<item_id:string,start:int,length:int>>")
    close = F.flatten(F.transform("_c", lambda c: F.transform(F.filter(c["sums"], lambda x: x["same"] < x["length"]), lambda s: F.struct(
        c["item_id"].alias("item_id"), s["start"].alias("start"), s["same"].alias("same")))))
    df = df.withColumn("_n", F.coalesce(F.array_sort(F.array_distinct(close)), F.array().cast("array<struct<item_id:string,start:int,same:int>>")))
    return df.select(
        "row", "n_words", F.coalesce(hits, none).alias("hits"),
        F.coalesce(F.size(F.array_distinct(spots)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(names, F.array().cast("array<string>")).alias("item_ids"),
        F.col("_n").alias("near"), F.size("_n").cast("long").alias("n_proximity"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and hashes of the exact phrases and of the proximity matches
    (item:start:same, comma-joined)."""
    n_hit = F.greatest(F.col("n_hit"), F.lit(0)).cast("long")
    named = F.transform("near", lambda m: F.concat_ws(":", m["item_id"], m["start"], m["same"]))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                        F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"), "n_proximity",
                        F.sha2(F.array_join(named, ","), 256).alias("proximity_sha256"))


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark phrase, with their columns."""
    return rows_where(find(docs, benchmark, **options), F.col("n_hit") <= 0)
