"""Secret scans: patterns, and entropy of what the patterns can't name.

Three patterns give the base spans (assignments, access keys, long hex runs).
On top of them, candidate strings of key-like characters are scanned with a
sliding window: the window's Shannon entropy within one character class (hex,
or letters and digits) follows from character counts that are updated by the
character that enters and the one that leaves. A candidate whose highest window
entropy reaches its class's threshold is a secret, unless the allow-list names
it; of a candidate with '=' the list must name the value too, so a harmless
name hides nothing. Built-in functions only; positions are code points, end
exclusive.

Positions come from splitting a text by the pattern: the pieces and the matches
alternate, so running sums of their lengths are the spans.

Defined results: null text counts as empty and gives no span (the hash is that
of the empty string); each row is scanned alone, so repeated rows give equal
results; very long texts are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_or_empty

#: Patterns of the base kinds, in their listed order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"

#: Key-like strings; a candidate must hold a digit and a letter.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits per character that the best window must reach: hex strings (at most 4
#: bits) and others (log2(20) = 4.32 at most in a window of 20).
HEX_BITS, MIXED_BITS = 3.0, 3.7
#: Allow-list: well-known harmless strings.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|x{6,}|0{8,}|"
    r"abcdefghij|0123456789|^[a-z]+([_/-][a-z]+)*$|"
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|"
    # paths and names: lower case only, and not with four letters or digits (of any case) at the end
    r"(?-i:^/?[a-z0-9_]+(/[a-z0-9_]+)*\.?$)(?<![A-Z0-9]{4})")

#: Matches of a text whose places are summed up together.
SUM_BLOCK = 64
SPAN = "array<struct<start:int,rank:int,end:int,text:string>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, pattern: str, rank: int, keep) -> Column:
    """Matches of ``pattern`` for which ``keep(match)`` holds, as SPAN.

    Positions are running sums of the lengths of the pieces, taken in blocks of
    ``SUM_BLOCK`` matches that each start at the sum of the blocks before: an array
    that grows by one match at a time would be copied for every match of a text."""
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    step = lambda x: x["gap"] + F.length(x["m"])

    def in_block(block, at):
        return F.aggregate(
            block, F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + step(x)).alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"),
                    (acc["at"] + step(x)).alias("end"), x["m"].alias("text")))).cast(SPAN).alias("out")),
            lambda acc: acc["out"])

    def spans(parts):
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / SUM_BLOCK).cast("int")),
                             lambda b: F.slice(parts, b * SUM_BLOCK + 1, SUM_BLOCK))
        return _let(blocks, lambda bl: _let(
            F.transform(bl, lambda one: F.aggregate(one, F.lit(0), lambda n, x: n + step(x))),
            lambda sums: F.flatten(F.transform(bl, lambda one, b: in_block(
                one, F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda n, x: n + x))))))

    lengths = F.zip_with(F.split(text, pattern, -1), found, lambda a, m: F.struct(F.length(a).alias("gap"), m.alias("m")))
    parts = F.filter(lengths, lambda x: x["m"].isNotNull())
    return F.when(F.size(found) > 0, F.filter(_let(parts, spans), lambda s: keep(s["text"]))).otherwise(F.array().cast(SPAN))


def window_entropy(s: Column, width: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits) of any ``width`` characters of ``s``.

    The state holds the counts of the distinct characters of ``s`` within the
    window and the sum of c*log2(c) over them; one step adds one character and
    drops the one ``width`` back, changing two counts."""
    chars = F.split(s, "")
    alphabet = F.array_distinct(chars)
    index = F.transform(chars, lambda c: F.array_position(alphabet, c).cast("int"))
    clog = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def step(acc, x):
        in_count = F.element_at(acc["counts"], x["enters"])
        grown = clog(in_count + 1) - clog(in_count)
        after = F.transform(acc["counts"], lambda c, k: F.when(k + 1 == x["enters"], c + 1).otherwise(c))
        out_count = F.when(x["leaves"] > 0, F.element_at(after, F.greatest(x["leaves"], F.lit(1))))
        total = acc["sum"] + grown + F.coalesce(clog(out_count - 1) - clog(out_count), F.lit(0.0))
        counts = F.transform(after, lambda c, k: F.when(k + 1 == x["leaves"], c - 1).otherwise(c))
        bits = F.lit(math.log2(width)) - total / F.lit(float(width))
        best = F.when(x["at"] >= width - 1, F.greatest(acc["best"], bits)).otherwise(acc["best"])
        return F.struct(counts.alias("counts"), total.alias("sum"), best.alias("best"))

    steps = F.transform(index, lambda e, i: F.struct(
        e.alias("enters"), i.alias("at"),
        F.when(i >= width, F.element_at(index, F.greatest(i - width + 1, F.lit(1)))).otherwise(F.lit(0)).alias("leaves")))
    start = F.struct(F.transform(alphabet, lambda c: F.lit(0)).alias("counts"),
                     F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    return F.aggregate(steps, start, step, lambda acc: acc["best"])


def _allowed(s: Column) -> Column:
    """Whether the allow-list names the candidate and each of its values: the
    last part between '=' and the others that are too long for a name."""
    parts = F.filter(F.split(s, "="), lambda x: x != "")
    values = F.filter(parts, lambda x, i: (F.length(x) >= WINDOW) | (i == F.size(parts) - 1))
    return s.rlike(ALLOWED) & F.forall(values, lambda x: x.rlike(ALLOWED))


def _suspect(s: Column) -> Column:
    mixed = s.rlike("[0-9]") & s.rlike("[A-Za-z]")
    is_hex = s.rlike("^[0-9a-fA-F]+$")
    enough = window_entropy(s) >= F.when(is_hex, F.lit(HEX_BITS)).otherwise(F.lit(MIXED_BITS))
    return F.when(~mixed, F.lit(False)).when(_allowed(s), F.lit(False)).otherwise(enough)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts of the base kinds, the hash of the base
    spans, all spans as text, ``n_entropy`` (suspect candidates, those that a
    base span covers included), and ``found`` (array of kind, start, end, text)."""
    df = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_x"))
    x = F.col("_x")
    df = df.select(
        "doc_id",
        _spans(x, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 8).alias("assign"),
        _spans(x, ACCESS, 1, lambda m: F.length(m) >= 16).alias("access"),
        _spans(x, HEX, 2, lambda m: F.length(m) >= 32).alias("hex"),
        _spans(x, CANDIDATE, 3, _suspect).alias("entropy"))
    df = df.withColumn("_base", F.array_sort(F.concat("assign", "access", "hex")))
    # entropy spans that a base span already covers say nothing new
    extra = F.filter("entropy", lambda e: ~F.exists("_base", lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])))
    df = df.withColumn("_all", F.array_sort(F.concat("_base", extra)))
    kinds = F.array(F.lit("assign"), F.lit("access"), F.lit("hex"), F.lit("entropy"))
    named = lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])
    joined = lambda c: F.array_join(F.transform(c, named), ",")
    return df.select(
        "doc_id", F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"), F.sha2(joined("_base"), 256).alias("base_sha256"),
        joined("_all").alias("spans"), F.size("entropy").cast("long").alias("n_entropy"),
        F.transform("_all", lambda s: F.struct(F.element_at(kinds, s["rank"] + 1).alias("kind"), s["start"].alias("start"),
                                              s["end"].alias("end"), s["text"].alias("text"))).alias("found"))
