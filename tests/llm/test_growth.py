"""What grows with the input: shuffle files on disk, and pairs of long lists and groups."""

import os
import time

import numpy as np
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm import common, jaccard_join, line_dedup
from tests.llm import brute
from tests.llm.fixtures import norm, table


def _shuffle_files(spark):
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in disks for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def test_tables_and_checkpoints_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 97).alias("k")).agg(F.sum("id").alias("s"))
    held = [common.written(rows), common.checkpoint(rows), common.checkpoint(rows.join(rows.withColumnRenamed("s", "z"), "k"))]
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert [df.count() for df in held] == [97, 97, 97]
    assert rows.count() == 97 and len(rows.collect()) == 97


def test_the_setting_is_given_back_by_the_last_thread(spark):
    kept = spark.conf.get(session.CLEANUP, "false")
    first, second = session.freed_shuffles(spark), session.freed_shuffles(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(session.CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(session.CLEANUP) == kept


def _long_lines(rng, groups, per, size):
    """Lines of ``size`` and more words; in a group a few words differ."""
    out = []
    for g in range(groups):
        base = [f"w{g}x{i}" for i in range(int(rng.integers(size, size * 3)))]
        for _ in range(per):
            words = list(base)
            for i in rng.choice(len(words), int(rng.integers(0, len(words) // 5)), replace=False):
                words[i] = f"n{int(rng.integers(1 << 40))}"
            out.append(" ".join(words))
    return [out[i] for i in rng.permutation(len(out))]


def test_long_lines_match_across_both_sketches(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHORT", 2)
    monkeypatch.setattr(line_dedup, "BLOCK_ROWS", 4)
    lines = _long_lines(np.random.default_rng(3), 12, 6, 70)
    rows = [(i, "\n".join(lines[i * 4:i * 4 + 4])) for i in range(18)]
    got = norm(line_dedup.report(table(spark, rows)).collect())
    assert got == norm(brute.matching_lines(rows))
    assert sum(r[2] for r in got) > 10


def test_unrelated_long_lines_are_no_candidates(spark):
    """64 parities of lines of 150 words differ in some 32, what a match may differ in; 256 tell them apart."""
    rng = np.random.default_rng(4)
    lines = [(i, [f"v{int(x)}" for x in rng.choice(1 << 40, 150)]) for i in range(30)]
    coded = spark.createDataFrame(lines, "rid long, words array<string>")
    coded = coded.select("rid", F.lit(0).alias("ln"), F.lit(0).alias("pos"), line_dedup._ordered(",".join(["0"] * (1 << 16))).alias("tokens"))
    coded = coded.withColumn("n", F.size("tokens"))
    posted = coded.select("rid", line_dedup._shape("ln", "n", "pos").alias("shape"), line_dedup._sketch("tokens").alias("sketch"),
                          *line_dedup._wide("tokens", "n"))
    x, y = posted.alias("x"), posted.alias("y")
    assert x.join(y, (F.col("x.rid") < F.col("y.rid")) & line_dedup._may_match(80)).count() == 0
    assert x.join(y, (F.col("x.rid") == F.col("y.rid")) & line_dedup._may_match(80)).count() == 30


def _word_lines(rng, lines, words, vocabulary):
    """Lines of frequent words; every tenth is an earlier one with a word changed."""
    out = []
    for i in range(lines):
        line = [f"v{int(x)}" for x in rng.choice(vocabulary, words, replace=False)]
        if i % 10 == 9:
            line = [*out[int(rng.integers(i))][:-1], f"n{i}"]
        out.append(line)
    return [(i, " ".join(line)) for i, line in enumerate(out)]


def test_lines_of_frequent_words_stay_out_of_long_lists(spark, monkeypatch):
    """Each of 200 words stands in some 210 of 3000 lines, two of them together in few."""
    rows = _word_lines(np.random.default_rng(7), 3000, 14, 200)
    made, whole = [], line_dedup._long_lists

    def counted(rows, matched, percent):
        made.append(rows.count())
        return whole(rows, matched, percent)

    monkeypatch.setattr(line_dedup, "_long_lists", counted)
    got = norm(line_dedup.report(table(spark, rows)).collect())
    assert got == norm(brute.matching_lines(rows))
    assert sum(r[2] for r in got) >= 280
    assert sum(made) < len(rows) / 10, made


def test_lists_dealt_from_the_start_lose_no_match(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "DEALT_ROWS", 4)
    monkeypatch.setattr(line_dedup, "BLOCK_ROWS", 3)
    rows = _word_lines(np.random.default_rng(8), 200, 12, 40)
    for percent in (60, 80, 90):
        got = norm(line_dedup.report(table(spark, rows), percent=percent).collect())
        assert got == norm(brute.matching_lines(rows, percent))


def test_a_group_of_near_copies_forms_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(80):
        words = list(base)
        for at in rng.choice(200, 2 - (i % 13 == 0), replace=False):
            words[at] = f"u{i}"
        rows.append((i, " ".join(words)))
    made, whole = [], jaccard_join._candidates

    def counted(live, labels, percent, max_lag, **options):
        pairs = whole(live, labels, percent, max_lag, **options)
        if max_lag is None and not options.get("nearest"):
            made.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard_join, "_candidates", counted)
    got = [norm(jaccard_join.components_of(table(spark, rows)).collect())]
    monkeypatch.setattr(jaccard_join, "NEAREST_ROUNDS", 0)
    got.append(norm(jaccard_join.components_of(table(spark, rows)).collect()))
    assert got == [norm(brute.components(rows))] * 2
    assert made[0] < made[1] / 2, made
