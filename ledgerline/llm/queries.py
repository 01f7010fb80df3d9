"""Registered queries of the package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (decontaminate, hash_sharding, jaccard_join, line_dedup, packing, periodic_runs, quality_rules, secret_scan,
                            substring_dedup, suffix_dedup, url_filter, warc, whitening)
from ledgerline.llm.common import read, words_of

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf, "documents"), with_text=False).drop("kept")


#: Byte limit of a shard of op2: small, so that the buckets of the given tables split many times.
SHARD_BYTES = 128 << 10


def op2_hash_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return hash_sharding.shard(read(spark, sf, "documents"), SHARD_BYTES)


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.report(read(spark, sf, "documents"))


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.score(read(spark, sf, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), *quality_rules.BASE, "base_failed", "kept")


def op5_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.components_of(read(spark, sf, "documents"))


def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf, "documents")).drop("found")


def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return decontaminate.digest(found)


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.roundtrip(read(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"))


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.dedup(read(spark, sf, "documents"), with_text=False).drop("kept")


def _with_planted_period(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents, chosen by the CRC-32 of doc_id, the words from
    a certain place on repeat a certain number of words; null ids stay."""
    df = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    df = df.select("doc_id", "text", F.when(F.col("h") % 10 == 0, words_of(F.col("text"))).alias("w"), F.floor(F.col("h") / 10).alias("g"))
    n = F.size("w")
    df = df.select("doc_id", "text", "w", n.alias("n"), F.when(n > 0, (F.col("g") % n).cast("int")).alias("a"), "g")
    rest = F.col("n") - F.col("a")
    df = df.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    unit = F.slice("w", F.col("a") + 1, F.col("p"))
    again = F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("p")).cast("int")))
    planted = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest))
    return df.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs.find(_with_planted_period(read(spark, sf, "documents")), keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    best = F.col("best")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: The production list of op12.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op12_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    return url_filter.judge(read(spark, sf, "pages"), rules, keep=["page_id"]).select(
        F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read(spark, sf, "embeddings"), keep=["vec_id"]).select(
        F.col("row.vec_id").alias("vec_id"), "component", "n", F.col("deviation").cast("long").alias("deviation"),
        "whitened", "explained", "identity_error")


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_suffix_dedup, op2_hash_sharding, op3_line_dedup, op4_quality_rules, op5_jaccard_join, op6_secret_scan, op7_decontaminate, op8_warc, op9_packing,
        op10_substring_dedup, op11_periodic_runs, op12_url_filter, op13_whitening)}
