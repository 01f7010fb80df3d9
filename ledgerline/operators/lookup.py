"""Fact key lookup against the active dimension versions.

Each dimension contributes (natural id -> surrogate key) from its active rows.
The joins carry no hint: Catalyst broadcasts a side whose size in bytes is
below the session's threshold, AQE turns a shuffle join into a broadcast join
from run-time sizes and splits skewed partitions.

``salted=True`` splits hot keys explicitly (one customer may hold a third of
all sales): one partial-aggregate pass counts the sales of all three keys, a
key is split by its count, its sales are spread by a hash of the row id and the
lookup row is copied once per split. NULL keys stay out of the join. The result
is the plain join's; no row is dropped or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.predicates import active_rows
from ledgerline.plans.profiles import DIMENSIONS, Profile
from ledgerline.session import materialize

# Rows of one key that a task of a salted lookup takes.
ROWS_PER_SALT = 1_000_000


def hot_splits(df: DataFrame, keys: list[str], rows_per_salt: int) -> DataFrame:
    """(key_name, key, splits) of the keys of any of the columns ``keys`` with
    more than ``rows_per_salt`` rows, from one pass; NULL is a key like any
    other. There are at most ``len(keys) * rows / rows_per_salt`` of them."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).cast("long").alias("key"))
                                for k in keys]))
    return (df.select(pairs.alias("p")).groupBy("p.key_name", "p.key").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > rows_per_salt)
              .select("key_name", "key", F.ceil(F.col("n") / rows_per_salt).cast("int").alias("splits")))


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str,
                rows_per_salt: int = ROWS_PER_SALT, row_id: list[str] | None = None,
                hot: DataFrame | None = None) -> DataFrame:
    """``left JOIN right ON left_key = right_key`` with hot keys split.

    A key gets as many splits as its count asks for. Left rows of a hot key are
    spread by a hash of the row id (the same in a retried task), the right row
    is copied once per split. NULL keys match nothing; they are kept out of the
    join, so they are never shuffled into one task.
    ``hot``: the result of ``hot_splits`` when the caller has it already."""
    if hot is None:
        hot = hot_splits(left, [left_key], rows_per_salt)
    hot = hot.where((F.col("key_name") == left_key) & F.col("key").isNotNull()).select(
        F.col("key").alias("_hot_key"), F.col("splits").alias("_splits"))
    rid = F.xxhash64(*[F.col(c) for c in (row_id or left.columns)])
    unknown = left.where(F.col(left_key).isNull())
    lft = left.where(F.col(left_key).isNotNull())
    lft = (lft.join(hot, lft[left_key].cast("long") == hot["_hot_key"], "left").drop("_hot_key")
           .withColumn("_salt", F.coalesce(F.pmod(rid, F.col("_splits")), F.lit(0)).cast("int")).drop("_splits"))
    rgt = (right.join(hot, right[right_key].cast("long") == hot["_hot_key"], "left").drop("_hot_key")
           .withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)))
           .drop("_splits"))
    cond = (lft[left_key] == rgt[right_key]) & (lft["_salt"] == rgt["_rsalt"])
    joined = lft.join(rgt, cond, how).drop("_salt", "_rsalt")
    if how != "left":
        return joined
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return joined.unionByName(unknown.select("*", *nulls))


def dim_lookup(dim: DataFrame, dim_name: str, profile: Profile) -> DataFrame:
    spec = DIMENSIONS[dim_name]
    rows = active_rows(dim)
    if profile.lookup_on_source_system:
        rows = rows.filter(F.col("source_system") == F.lit(profile.source_system))
    return rows.select(F.col(spec.natural_id).alias(f"_lk_{spec.natural_id}"),
                       F.col(spec.key_col))


def lookup_keys(sales: DataFrame, dims: dict[str, DataFrame], profile: Profile,
                salted: bool = False, rows_per_salt: int = ROWS_PER_SALT,
                row_id: list[str] | None = ("sale_id",)) -> DataFrame:
    """Add customer_key / product_key / store_key to ``sales``.

    psql: LEFT join on natural id (unmatched rows kept, key NULL).
    gcp: INNER join on natural id and source_system (unmatched rows dropped).
    Catalyst and AQE choose broadcast or shuffle by size. ``salted``: split hot
    keys explicitly, for sales so skewed that AQE's skew join is not enough.
    """
    out = sales
    rid = [c for c in (row_id or []) if c in sales.columns] or None
    names = ("customer", "product", "store")
    hot = None
    if salted:
        # one pass over the input sales for all three keys
        hot = materialize(hot_splits(sales, [DIMENSIONS[n].natural_id for n in names], rows_per_salt))
    for name in names:
        spec = DIMENSIONS[name]
        lk = dim_lookup(dims[name], name, profile)
        lkey = f"_lk_{spec.natural_id}"
        if salted:
            out = salted_join(out, lk, spec.natural_id, lkey, profile.lookup_how, rows_per_salt, rid, hot=hot)
        else:
            out = out.join(lk, out[spec.natural_id] == lk[lkey], profile.lookup_how)
        out = out.drop(lkey)
    return out
