"""Line dedup by an exact set-similarity join.

A line is the set of its words. Two lines match if the Jaccard similarity of
their sets is at least ``percent``; a line that matches an earlier one (smaller
document, then line number) is removed. ``min_words`` > 1 leaves lines of fewer
words alone; by default every line with a word takes part.

Words have one order, rare before frequent, from a fixed number of hashed
counters over the whole corpus. In that order a line is also the set of its
neighbouring words: two sets that share ``o`` words and differ in ``d`` have at
least ``o - 1 - d`` neighbours in common, as every word of one set alone parts
one such pair at most. So matching lines share two neighbours among the first
``floor(2 * (1-t) * n) + 1`` (from 80 percent on; below, where no neighbours need be
shared, a word of the first ``n - ceil(t*n) + 1``), and lines meet in the
posting lists of these. Lists of two words stay short where those of one word
grow with the corpus, and their pairs with its square. A pair is dropped if the
sizes (length filter) or the places in both lines (positional filter) rule a
match out. Equal lines need no join: they collapse by hash before any posting is made.

A posting is three longs; those that stand alone in their list go in the task
that sees it. Lists of up to ``SHORT`` rows are paired in one self-join; in longer ones a line is held against the first of the list and its
two predecessors. Words whose counters stand out are dealt over blocks from
the start. Lines that this leaves unmatched are then tried against all earlier
rows of their long lists, dealt out in blocks: a group of near copies
does not form all its pairs, and no list is one task's work. There a sketch of 64
parities, which bounds how much two sets differ, rules out more (256 for lines of
``WIDE_FROM`` words on, whose sets may differ in more words than 64 parities show).
Candidates share as many postings as a match must, and are
verified on the whole sets: first, of each line, the one that shares most, then, for
lines that this leaves, all.
Built-in functions only.

Defined results: null text has no lines and stays null; lines without words
are never removed; documents that share an id, or have none, are documents of
their own, in the order of their text; ids may be numbers or texts. Words are
told apart by 57 bits of hash and their frequency class.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import (SPACE_CHARS, SPACE_CLASS, checkpoint, free_name, release, rows_where, text_or_empty,
                                   with_row_id, written)

COUNTER_BITS = 16
PERCENT, MIN_WORDS = 80, 1
#: Rows of a posting list that are paired at once, and rows of a block of a long one.
SHORT, BLOCK_ROWS = 64, 1024
CLASSES = 64
#: Percent from which matching lines of two words on share neighbours, and the usual rows of a list that is dealt from the start.
PAIRED_FROM, DEALT_ROWS = 80, 1 << 20
#: Distinct words from which a line has the wide sketch.
WIDE_FROM = 96
WIDE = ["w1", "w2", "w3"]
#: Largest checkpointed table, in bytes, that is broadcast; a larger one is shuffled to the same joins.
MAX_BROADCAST_BYTES = 16 << 20


def _words(line: Column) -> Column:
    """Words of a line that has some."""
    return F.split(F.btrim(line, F.lit(SPACE_CHARS)), SPACE_CLASS + "+")


def lines_of(texts: DataFrame, min_words: int) -> DataFrame:
    """(rid, ln, line) of the lines that take part."""
    word, gap = r"[^\x20\x09-\x0D]+", SPACE_CLASS
    enough = f"^{gap}*({word}{gap}+){{{min_words - 1}}}{word}" if min_words > 1 else word
    lines = texts.select("rid", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    return lines.where(F.col("line").rlike(enough))


def _cell(token: Column) -> Column:
    return F.shiftrightunsigned(token, 64 - COUNTER_BITS)


def rarity(texts: DataFrame) -> tuple[str, float]:
    """Frequency class of every counter (quarter octaves above the median load),
    as one comma-separated text of 2**COUNTER_BITS numbers, and the median."""
    used = (texts.select(F.explode(F.split("text", SPACE_CLASS + "+")).alias("word"))
            .groupBy(_cell(F.xxhash64("word")).alias("cell")).agg(F.count("*").alias("c")))
    cells = texts.sparkSession.range(1 << COUNTER_BITS).select(F.col("id").alias("cell")).join(used, "cell", "left")
    dense = cells.agg(F.array_sort(F.collect_list(F.struct("cell", F.coalesce("c", F.lit(0)).alias("c")))).alias("s"),
                      F.greatest(F.expr("percentile_approx(c, 0.5)"), F.lit(1)).alias("u"))
    level = F.transform("s", lambda x: F.when(x["c"] <= F.col("u"), 0).otherwise(
        F.least(F.floor(4 * F.log2(x["c"] / F.col("u"))), F.lit(CLASSES - 1))).cast("string"))
    return tuple(dense.select(F.array_join(level, ","), F.col("u").cast("double")).first())


def _ordered(classes: str) -> Column:
    """The distinct words of a line in the common order, as longs. The classes
    are a constant of the plan."""
    table = F.split(F.lit(classes), ",").cast("array<bigint>")
    hashed = F.transform("words", lambda word: F.xxhash64(word))
    return F.sort_array(F.array_distinct(F.transform(hashed, lambda t: F.shiftleft(
        F.get(table, _cell(t).cast("int")), 57).bitwiseOR(F.shiftrightunsigned(t, 7)))))


def _sketch(tokens: str) -> Column:
    """64 parities of hashed token counts: the number of bits in which two
    sketches differ is at most the size of the symmetric difference."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))))


def _wide(tokens: str, n: str) -> list[Column]:
    """Three of the four longs that make the sketch of a long line 256 parities; their
    exclusive or, the sketch, gives the fourth. Null for shorter lines."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))
    part = lambda k: F.aggregate(tokens, F.lit(0).cast("long"), lambda a, t: F.when(
        F.shiftright(t, 6).bitwiseAND(3) == k, a.bitwiseXOR(bit(t))).otherwise(a))
    return [F.when(F.col(n) >= WIDE_FROM, part(k)).alias(name) for k, name in enumerate(WIDE, 1)]


# A posting's ``shape``: line number, set size and place of the word in one long. Sizes
# and places beyond their bits stand at the largest value, which only weakens the filters.
_N_MOST, _POS_MOST = (1 << 24) - 1, 255


def _shape(ln: str, n: str, pos: str) -> Column:
    return F.shiftleft(F.col(ln).cast("long"), 32).bitwiseOR(
        F.shiftleft(F.least(F.col(n), F.lit(_N_MOST)).cast("long"), 8)).bitwiseOR(F.least(F.col(pos), F.lit(_POS_MOST)).cast("long"))


def _ln(shape: str) -> Column:
    return F.shiftright(shape, 32).cast("int")


def _before() -> Column:
    return (F.col("x.rid") < F.col("y.rid")) | ((F.col("x.rid") == F.col("y.rid")) & (_ln("x.shape") < _ln("y.shape")))


def _salt(blocks: list[int]) -> Column:
    """What is mixed into the word of a posting: 0, or for a word of a class of
    several blocks one of their numbers, by line."""
    per = F.get(F.array(*[F.lit(b) for b in blocks]), F.shiftrightunsigned("token", 57).cast("int"))
    return F.when(per > 1, F.shiftleft(F.pmod(F.xxhash64("rid", _ln("shape")), per) + 1, 20)).otherwise(F.lit(0).cast("long"))


def _keys(tokens: str, n: str, percent: int) -> Column:
    """What a line is posted under: its rarest words, each with its neighbour (a
    lone word by itself), in the frequency class of the first."""
    if percent < PAIRED_FROM:
        return F.slice(tokens, F.lit(1), F.col(n) - F.ceil(F.col(n) * percent / 100).cast("int") + 1)
    take = F.least(_posted(F.col(n), percent), F.col(n) - 1)
    two = F.zip_with(F.slice(tokens, F.lit(1), take), F.slice(tokens, F.lit(2), take), lambda a, b: F.shiftleft(
        F.shiftrightunsigned(a, 57), 57).bitwiseOR(F.shiftrightunsigned(F.xxhash64(a, b), 7)))
    return F.when(F.col(n) > 1, two).otherwise(F.col(tokens))


def _posted(n: Column, percent: int) -> Column:
    """Of how many words of a line of ``n`` the neighbours are posted, if it has so many."""
    return (F.floor((200 - 2 * percent) * n / 100) + 1).cast("int")


def _sizes(s: str) -> Column:
    return F.shiftright(f"{s}.shape", 8).bitwiseAND(_N_MOST)


def _fits(percent: int) -> Column:
    """Length and positional filters for postings x (earlier) and y."""
    place = lambda s: F.col(f"{s}.shape").bitwiseAND(_POS_MOST)
    small, large = F.least(_sizes("x"), _sizes("y")), F.greatest(_sizes("x"), _sizes("y"))
    bound = F.least(place("x"), place("y")) + F.least(_sizes("x") - place("x"), _sizes("y") - place("y"))
    # J >= p/100  <=>  (100 + p) * overlap >= p * (n1 + n2)  <=>  (100 + p) * difference <= (100 - p) * (n1 + n2)
    return (100 * small >= percent * large) & ((100 + percent) * bound >= percent * (small + large))


def _may_match(percent: int) -> Column:
    """Length, positional and parity filters for postings x (earlier) and y."""
    differ = F.bit_count(F.col("x.sketch").bitwiseXOR(F.col("y.sketch")))
    parts = [F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}")) for c in WIDE]
    rest = F.col("x.sketch").bitwiseXOR(F.col("y.sketch"))
    for part in parts:
        rest = rest.bitwiseXOR(part)
    wide = sum((F.bit_count(part) for part in parts), F.bit_count(rest))  # null if a line is short
    most = (100 - percent) * (_sizes("x") + _sizes("y"))
    return _fits(percent) & ((100 + percent) * differ <= most) & F.coalesce((100 + percent) * wide <= most, F.lit(True))


def _named(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of places from joined postings x and y, and how many postings a match
    shares at least: what the sets must have in common, less what comes after
    the postings of the larger line."""
    nx, ny = _sizes("x"), _sizes("y")
    overlap, most = F.ceil(percent * (nx + ny) / (100 + percent)), F.greatest(nx, ny)
    if percent < PAIRED_FROM:
        need = overlap - F.ceil(percent * most / 100) + 1
    else:
        need = F.greatest(3 * overlap - 1 - nx - ny - F.greatest(most - 1 - _posted(most, percent), F.lit(0)), F.lit(1))
    at = lambda s: F.struct(F.col(f"{s}.rid").alias("rid"), _ln(f"{s}.shape").alias("ln"))
    return rows.select(at("x").alias("x"), at("y").alias("y"), need.cast("int").alias("need"))


def _bounded(df: DataFrame, row_bytes: int = 24) -> DataFrame:
    """A checkpointed table of narrow rows, for broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if df.count() * row_bytes <= MAX_BROADCAST_BYTES else df


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of each y the pair that shares most."""
    return pairs.groupBy("y").agg(F.min(F.struct(-F.col("k"), "x")).alias("best")).select("best.x", "y")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Lines (rid, ln) of the pairs (x, y) whose sets match."""
    a = sets.select(F.struct("rid", "ln").alias("x"), F.col("tokens").alias("tx"))
    b = sets.select(F.struct("rid", "ln").alias("y"), F.col("tokens").alias("ty"))
    both = pairs.join(a, "x").join(b, "y")
    inter = F.size(F.array_intersect("tx", "ty"))
    union = F.size("tx") + F.size("ty") - inter
    return both.where(100 * inter >= percent * union).select("y.rid", "y.ln").distinct()


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that 16 bits of every word don't rule out: the shared codes, and
    as many words as share a code with another of their own line, bound the
    overlap, so no match is lost and far fewer bytes move with a pair."""
    codes = sets.select("rid", "ln", F.size("tokens").alias("n"), F.array_distinct(
        F.transform("tokens", lambda t: (t.bitwiseAND(0xFFFF) - 32768).cast("smallint"))).alias("c"))
    a = codes.select(F.struct("rid", "ln").alias("x"), F.col("c").alias("cx"), F.col("n").alias("nx"))
    b = codes.select(F.struct("rid", "ln").alias("y"), F.col("c").alias("cy"), F.col("n").alias("ny"))
    most = F.size(F.array_intersect("cx", "cy")) + F.col("nx") - F.size("cx")
    return pairs.join(a, "x").join(b, "y").where((100 + percent) * most >= percent * (F.col("nx") + F.col("ny"))).select("x", "y")


def _long_lists(rows: DataFrame, matched: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of the long lists' rows (token, rid, shape, sketch, wide), y not
    yet matched, x any earlier row: each block of a list's rows meets each block of its open ones."""
    done = _bounded(matched).select(F.col("rid").alias("mr"), F.col("ln").alias("ml"))
    open_ = rows.join(done, (F.col("rid") == F.col("mr")) & (_ln("shape") == F.col("ml")), "left_anti")
    blocks = F.ceil(F.count("*") / BLOCK_ROWS).cast("int")
    per = _bounded(checkpoint(rows.groupBy("token").agg(blocks.alias("xs")).join(open_.groupBy("token").agg(blocks.alias("ys")), "token")))

    def dealt(some: DataFrame, own: str, of: str, other: str, others: str) -> DataFrame:
        some = some.join(per, "token").withColumn(own, F.pmod(F.xxhash64(F.lit(1), "rid", "shape"), F.col(of)).cast("int"))
        return some.select("*", F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other)).select(
            "token", "i", "j", "rid", "shape", "sketch", *WIDE)

    x, y = dealt(rows, "i", "xs", "j", "ys").alias("x"), dealt(open_, "j", "ys", "i", "xs").alias("y")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
                 & _before() & _may_match(percent))
    return _named(met, percent)


def removed_lines(texts: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(rid, ln) of the lines of ``texts`` (rid, text) that match an earlier one."""
    lines = lines_of(texts, min_words)
    classes, usual = rarity(texts)
    blocks = [max(1, math.ceil(usual * 2 ** ((c + 1) / 4) / DEALT_ROWS)) for c in range(CLASSES)]
    line_key = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")]
    place = F.struct("rid", "ln")
    coded = lines.select("rid", "ln", *line_key, _words(F.col("line")).alias("words"))
    coded = coded.select("rid", "ln", "h1", "h2", _ordered(classes).alias("tokens")).withColumn("n", F.size("tokens"))
    firsts = coded.select("rid", "ln", "h1", "h2", F.struct("n", _keys("tokens", "n", percent).alias("keys")).alias("s"))
    firsts = written(firsts.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.first("s").alias("s"), F.count("*").alias("c")))
    # equal lines: all but the first go, and that one stands for them
    several = checkpoint(firsts.where("c > 1").select("h1", "h2", "first"))
    copies = checkpoint(lines.select("rid", "ln", *line_key).join(_bounded(several, 48), ["h1", "h2"]).where(
        place != F.col("first")).select("rid", "ln"))
    postings = (firsts.select("first.rid", "first.ln", "s.n", F.posexplode("s.keys").alias("pos", "token"))
                .select("token", "rid", _shape("ln", "n", "pos").alias("shape")))
    salt = _salt(blocks)
    # most postings stand alone: one pass over the lists leaves the others
    alone = postings.select(F.col("token").bitwiseXOR(salt).alias("token"), "rid", "shape").withColumn(
        "c", F.count("*").over(Window.partitionBy("token")))
    shared = written(alone.where((F.col("c") > 1) | (salt != 0)))

    lists = shared.where("c > 1").withColumn("r", F.row_number().over(Window.partitionBy("token").orderBy("rid", "shape")))
    near = (F.col("y.c") <= SHORT) | (F.col("x.r") == 1) | (F.col("y.r") - F.col("x.r") <= 2)
    met = lists.alias("x").join(lists.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.r") < F.col("y.r")) & near & _fits(percent))
    met = written(_named(met, percent).groupBy("x", "y").agg(F.count("*").alias("k"), F.first("need").alias("need")))

    def named(pairs: DataFrame) -> DataFrame:
        return pairs.select("x.*").union(pairs.select("y.*"))

    def named_lines(wanted: DataFrame) -> DataFrame:
        """(rid, ln, tokens) of the lines (rid, ln) named in ``wanted``."""
        wanted = wanted.groupBy("rid").agg(F.collect_set("ln").alias("lns"))
        # split before the join: below it the lines stay a column of their own
        chosen = texts.select("rid", F.split("text", "\n").alias("lines")).join(wanted, "rid")
        chosen = chosen.select("rid", F.explode(F.transform("lns", lambda i: F.struct(
            i.alias("ln"), F.get(F.col("lines"), i).alias("line")))).alias("l")).select("rid", "l.ln", _words(F.col("l.line")).alias("words"))
        return chosen.select("rid", "ln", _ordered(classes).alias("tokens"))

    hot = shared.where((F.col("c") > SHORT) | (salt != 0)).select(
        F.col("token").bitwiseXOR(salt).alias("token"), "rid", _ln("shape").alias("ln"), "shape")
    # a pair that shares enough does so in short lists, or is of lines of long ones
    likely = met.where("k >= need")
    known = checkpoint(named_lines(named(likely).union(hot.select("rid", "ln"))))

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        return checkpoint(_verified(checkpoint(_plausible(pairs, sets, percent)), sets, percent))

    matched = verified(checkpoint(_likeliest(likely)), known)
    release(texts.sparkSession)
    # lines that this left: each posting that a pair shares stands in a short list or in a long one
    done = _bounded(matched).select(F.struct("rid", "ln").alias("y"))
    both = likely.join(done, "y", "left_anti").select("x", "y", "k", "need")
    if not hot.isEmpty():
        # a pair that shares too little so far can share more only if long lists hold both its lines
        place_of = _bounded(checkpoint(hot.select(place.alias("at")).distinct()))
        few = met.where("k < need").join(place_of.select(F.col("at").alias("y")), "y", "left_semi")
        few = few.join(place_of.select(F.col("at").alias("x")), "x", "left_semi").join(done, "y", "left_anti")
        marks = known.withColumn("n", F.size("tokens")).select("rid", "ln", _sketch("tokens").alias("sketch"), *_wide("tokens", "n"))
        rows = checkpoint(hot.join(marks, ["rid", "ln"]).select("token", "rid", "shape", "sketch", *WIDE))
        far = written(_long_lists(rows, matched, percent).groupBy("x", "y").agg(F.count("*").alias("k"), F.first("need").alias("need")))
        both = both.unionByName(few.select("x", "y", "k", "need")).unionByName(far).groupBy("x", "y").agg(F.sum("k").alias("k"), F.first("need").alias("need"))
    left = checkpoint(both.where("k >= need").select("x", "y"))
    return copies.unionByName(matched).unionByName(verified(left, checkpoint(known.join(_bounded(named(left).distinct()), ["rid", "ln"], "left_semi")))).distinct()


def dedup(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row`` (its text left out), with ``kept`` (the
    text without the removed lines), n_lines, n_removed and ``removed`` (sorted line numbers)."""
    rid = free_name(docs)
    keyed = with_row_id(docs, id_col, text_col, rid)
    gone = removed_lines(keyed.select(F.col(rid).alias("rid"), text_or_empty(text_col).alias("text")), percent, min_words)
    per = gone.groupBy("rid").agg(F.sort_array(F.collect_set("ln")).alias("removed"))
    others = F.struct(*[F.col(f"`{c}`") if c != text_col else F.lit(None).cast("string").alias(c) for c in docs.columns])
    df = keyed.select(F.col(rid).alias("rid"), others.alias("row"), F.split(text_col, "\n").alias("_l")).join(per, "rid", "left")
    rest = F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), F.col("removed"))
    kept = F.when(F.col("removed").isNull(), F.array_join("_l", "\n")).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(F.col("_l"), i)), "\n"))
    return df.select("row", kept.alias("kept"), F.when(F.col("_l").isNull(), 0).otherwise(F.size("_l")).cast("long").alias("n_lines"),
                     F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                     F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def report(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed and the removed line numbers; moves no text."""
    rid = free_name(docs)
    keyed = with_row_id(docs, id_col, text_col, rid)
    gone = removed_lines(keyed.select(F.col(rid).alias("rid"), text_or_empty(text_col).alias("text")), percent, min_words)
    per = gone.groupBy("rid").agg(F.sort_array(F.collect_set("ln")).alias("removed"))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n"))).cast("long")
    return keyed.select(F.col(rid).alias("rid"), F.col(id_col).alias("doc_id"), n_lines.alias("n_lines")).join(per, "rid", "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"))


def filter_lines(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with the removed lines taken out of the text; ``length_col``,
    where the table has it, follows. Documents that lose their last word go."""
    out = dedup(docs, text_col=text_col, **options)
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("kept").alias(c))
        elif c == length_col and length_col in docs.columns:
            own = F.col("row").getField(c)
            columns.append(F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema[c].dataType)).otherwise(own).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    has_words = (F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]")
    return rows_where(out.select(F.struct(*columns).alias("row"), has_words.alias("ok")), F.col("ok"))
