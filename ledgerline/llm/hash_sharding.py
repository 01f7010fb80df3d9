"""Sharding by extendible hashing.

Every document has a 60-bit hash of its id and text. A shard is a bucket of the
directory: all documents whose hash starts with the shard's ``depth`` bits.
Starting from one bucket of depth 0, only buckets over the byte limit are split
on one more bit, until every shard fits. The directory is built from byte sums
per hash prefix (added up before the shuffle), a few levels at a time, so no
bucket's documents are ever gathered anywhere.

Defined results: null or empty text has 0 bytes; null ids hash like the empty
string. Rows equal in id and text share all hash bits and can't be separated:
a bucket that holds a single hash is left over the limit and marked
``oversized``, as is one document larger than the limit. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint, text_or_empty

HASH_BITS = 60
#: Directory levels worked out at a time, at most.
LEVELS = 12
#: Production limit of a shard.
LIMIT_BYTES = 8 * 1024 * 1024


def _hash(id_col: str, text: Column) -> Column:
    """60 bits of md5 over the id and the md5 of the text."""
    name = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column) -> Column:
    return F.call_function("shiftright", h, (F.lit(HASH_BITS) - depth).cast("int"))


def directory(sized: DataFrame, limit_bytes: int) -> DataFrame:
    """Leaf buckets (depth, prefix, shard_bytes, oversized) of rows (h, n_bytes)."""
    leaves = None
    live = sized.select("h", "n_bytes", F.lit(0).alias("base"))
    base, ahead = 0, LEVELS
    while base <= HASH_BITS:
        top = min(base + ahead, HASH_BITS)
        fine = (live.groupBy(_prefix(F.col("h"), F.lit(top)).alias("fine"))
                .agg(F.sum("n_bytes").alias("b"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        depths = F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth")
        levels = (fine.select("*", depths)
                  .withColumn("prefix", F.call_function("shiftright", F.col("fine"), (F.lit(top) - F.col("depth")).cast("int")))
                  .groupBy("depth", "prefix")
                  .agg(F.sum("b").alias("shard_bytes"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
        fits = (F.col("shard_bytes") <= limit_bytes) | (F.col("lo") == F.col("hi"))
        levels = checkpoint(levels.withColumn("fits", fits))
        # a leaf fits while its parent, one bit shorter, doesn't
        over = levels.where(~F.col("fits")).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        inner = levels.where((F.col("depth") > base) & F.col("fits")).withColumn(
            "parent", F.call_function("shiftright", F.col("prefix"), F.lit(1)))
        found = inner.join(over, ["depth", "parent"], "left_semi").select(
            "depth", "prefix", "shard_bytes", (F.col("shard_bytes") > limit_bytes).alias("oversized"))
        if base == 0:
            found = found.unionByName(levels.where("depth = 0 AND fits").select(
                "depth", "prefix", "shard_bytes", (F.col("shard_bytes") > limit_bytes).alias("oversized")))
        leaves = found if leaves is None else leaves.unionByName(found)
        split = levels.where((F.col("depth") == top) & ~F.col("fits"))
        largest = split.agg(F.max("shard_bytes")).first()[0]
        if top == HASH_BITS or largest is None:
            return leaves
        # a bit halves a bucket, roughly: levels below the fitting one would be a row for nearly every document
        ahead = min(LEVELS, (int(largest) // max(limit_bytes, 1)).bit_length() + 1)
        live = live.join(split.select(F.col("prefix").alias("p")),
                         _prefix(F.col("h"), F.lit(top)) == F.col("p"), "left_semi")
        base = top
    return leaves


def shard(docs: DataFrame, limit_bytes: int = LIMIT_BYTES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, shard_depth, shard_prefix (its bits as
    a string), shard_bytes, oversized."""
    text = text_or_empty(text_col)
    sized = checkpoint(docs.select(F.col(id_col).alias("doc_id"), _hash(id_col, text).alias("h"),
                                   F.octet_length(text).cast("long").alias("n_bytes")))
    leaves = checkpoint(directory(sized, limit_bytes))
    # one join: a leaf matches on its own depth; the depths in use are few
    depths = F.array_sort(F.array_agg("d"))
    used = leaves.groupBy(F.col("depth").alias("d")).count().agg(depths.alias("depths")).first()["depths"]
    at = sized.withColumn("depth", F.explode(F.lit(used or [0]).cast("array<int>")))
    at = at.withColumn("prefix", _prefix(F.col("h"), F.col("depth")))
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    return at.join(leaves, ["depth", "prefix"]).select(
        "doc_id", "n_bytes", F.col("depth").alias("shard_depth"), bits.alias("shard_prefix"),
        "shard_bytes", "oversized")
