"""Every operator against brute force, on odd rows and on the given tables."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerline.llm import (decontaminate, hash_sharding, jaccard_join, line_dedup, packing, periodic_runs, quality_rules, queries,
                            secret_scan, substring_dedup, suffix_dedup, warc, windows)
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.fixtures import CLASHING, norm, odd_texts, table

ITEMS = [(1, None), (2, ""), (3, "one"), (None, "lo lo lo"), (5, "zz yy")]


@pytest.fixture(scope="module")
def given(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def both(spark, given):
    rows = odd_texts()
    yield table(spark, rows), rows
    yield given


def test_suffix_dedup(spark, given):
    for df, rows in both(spark, given):
        got = suffix_dedup.dedup(df)
        assert norm(got.drop("kept").collect()) == norm(brute.suffix_dedup(rows))


def test_run_length_index_is_exact():
    rng = np.random.default_rng(5)
    for n, letters in ((1, 1), (40, 1), (300, 2), (900, 3)):
        text = rng.integers(97, 97 + letters, n).astype(np.uint8)
        text = np.concatenate([text, text[n // 4:], [255]]).astype(np.uint8)
        b = text.tobytes()
        by = sorted(range(len(b)), key=lambda i: b[i:])
        want = [0] * len(b)
        for x, y in zip(by, by[1:], strict=False):
            k = 0
            while max(x, y) + k < len(b) and b[x + k] == b[y + k]:
                k += 1
            want[x], want[y] = max(want[x], k), max(want[y], k)
        index = suffix_dedup.RunLengthIndex(text)
        assert list(index.matching_statistics()) == want
        assert int(index.lengths.sum()) == len(b)


def test_substring_dedup(spark, given):
    for df, rows in both(spark, given):
        assert norm(substring_dedup.dedup(df).drop("kept").collect()) == norm(brute.substring_dedup(rows))


def test_large_groups_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(windows, "GROUP_ITEMS", 1)
    rows = odd_texts(4)
    df = table(spark, rows)
    assert norm(suffix_dedup.dedup(df).drop("kept").collect()) == norm(brute.suffix_dedup(rows))
    assert norm(substring_dedup.dedup(df).drop("kept").collect()) == norm(brute.substring_dedup(rows))


def test_long_text_by_pieces(monkeypatch):
    monkeypatch.setattr(windows, "PIECE_UNITS", 1000)
    data = np.frombuffer(bytes(np.random.default_rng(1).integers(97, 101, 5000).astype(np.uint8)), np.uint8)
    spec = windows.Spec(40, 10, windows.byte_units, windows.byte_values, False)
    values, offs, _ = spec.units(data, np.array([0, 5000]))
    _, start, n, *_ = windows._runs(values, offs, spec)
    assert sorted(x for a, m in zip(start, n, strict=True) for x in range(a, a + m)) == list(range(5000 - 39))


def test_sharding(spark, given):
    for df, rows in both(spark, given):
        got = hash_sharding.shard(df, 20_000).collect()
        assert norm((r["doc_id"], r["n_bytes"]) for r in got) == norm((i, len((t or "").encode())) for i, t in rows)
        held = defaultdict(int)
        for r in got:
            held[r["shard_prefix"]] += r["n_bytes"]
        for r in got:
            assert held[r["shard_prefix"]] == r["shard_bytes"] and len(r["shard_prefix"]) == r["shard_depth"]
            assert (r["shard_bytes"] > 20_000) == r["oversized"]
        shards = sorted(held)
        assert all(not b.startswith(a) for a, b in zip(shards, shards[1:], strict=False))


def test_line_dedup(spark, given):
    for df, rows in both(spark, given):
        assert norm(line_dedup.report(df).collect()) == norm(brute.matching_lines(rows))


def test_line_dedup_with_long_lists(spark, given, monkeypatch):
    """Long lists go through pairs of blocks, and hot words over blocks from the start."""
    monkeypatch.setattr(line_dedup, "SHORT", 1)
    monkeypatch.setattr(line_dedup, "BLOCK_ROWS", 3)
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST_BYTES", 0)
    for df, rows in both(spark, given):
        assert norm(line_dedup.report(df).collect()) == norm(brute.matching_lines(rows))


def test_line_dedup_of_all_lines(spark, given):
    """Lines of one to three words go too, unless they are left out."""
    for df, rows in both(spark, given):
        assert norm(line_dedup.report(df, min_words=4).collect()) == norm(brute.matching_lines(rows, min_words=4))
    rows = [(1, "All rights reserved.\nMenu"), (2, "Menu\n  All rights reserved. \nRead more"), (3, "Read more\n \nMenu now")]
    got = {r["doc_id"]: r["removed"] for r in line_dedup.report(table(spark, rows)).collect()}
    assert got == {1: "", 2: "0,1", 3: "0"}


def test_line_dedup_keeps_columns(spark):
    df = table(spark, odd_texts())
    out = line_dedup.filter_lines(df)
    assert out.columns == df.columns
    assert {r["kept"] for r in out.collect()} == {"kept"}
    full = line_dedup.dedup(df).select("row.doc_id", "kept", "n_removed").collect()
    assert norm((r["doc_id"], r["kept"]) for r in full if not r["n_removed"]) == norm(
        (r["doc_id"], r["text"]) for r, n in zip(
            sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")),
            brute.matching_lines(odd_texts()), strict=True) if not n[2])


def test_quality_rules(spark, given):
    for df, rows in both(spark, given):
        got = quality_rules.score(df).select("row.doc_id", *quality_rules.BASE, "base_failed").collect()
        assert norm(got) == norm(brute.quality(rows))


def test_quality_rules_on_labels(spark, given):
    """All junk goes; clean documents that pass the base rules stay."""
    df, _ = given
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = quality_rules.score(df).select("row.doc_id", "base_failed", "kept").join(labels, "doc_id").collect()
    assert not [r for r in got if r["quality"] == 0 and r["kept"]]
    assert not [r for r in got if r["quality"] == 1 and not r["kept"] and not r["base_failed"]]


def test_stop_words_are_asked_of_listed_languages(spark):
    polish = " ".join(f"słowo{i} książka{i}" for i in range(40))
    chinese = " ".join(chr(0x4E00 + i) * 20 + chr(0x5E00 + i) for i in range(60))
    rows = [(1, polish, "pl"), (2, polish, "en"), (3, polish, None), (4, polish, "EN-us"), (5, chinese, "zh-CN"), (6, chinese, "pl"),
            (7, polish, "pt_BR"), (8, "# " * 100 + polish, "pl"), (9, "the " + polish, "en"), (10, polish, "und")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in quality_rules.filter_documents(df).collect()} == {1, 5, 7, 9}
    assert quality_rules.filter_documents(df.drop("lang")).count() == 1


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_join(spark, given, k, percent):
    for df, rows in both(spark, given):
        got = jaccard_join.components_of(df, shingle=k, percent=percent).collect()
        assert norm(got) == norm(brute.components(rows, k, percent))


def test_jaccard_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "COSTS", (0, 0, 1, 2))
    rows = odd_texts(6)
    got = jaccard_join.components_of(table(spark, rows), shingle=3, percent=80).collect()
    assert norm(got) == norm(brute.components(rows, 3, 80))


def test_jaccard_join_asks_small_sets_for_no_more_than_they_share(spark, monkeypatch):
    """At 0.8, sets of 4 and 5 shingles link with 4 in common."""
    monkeypatch.setattr(jaccard_join, "COSTS", (0, 0, 0, 0))
    base = "a b c d e f g h"
    rows = [(1, base), (2, base)] + [(10 + i, f"{base} end{i}") for i in range(8)] + [(30 + i, f"start{i} {base}") for i in range(8)]
    got = jaccard_join.components_of(table(spark, rows), shingle=5, percent=80).collect()
    assert norm(got) == norm(brute.components(rows, 5, 80))
    assert {r["component_id"] for r in got} == {1}


def test_keep_one(spark):
    rows = odd_texts()
    df = table(spark, rows)
    got = jaccard_join.keep_one(df)
    assert got.columns == df.columns
    found = brute.components(rows, 5, 80)
    assert got.count() == sum(1 for _ in {(c[2], c[1]) for c in found if c[2] is not None and c[0] == c[2]}) + \
        sum(1 for _ in got.where("doc_id IS NULL").collect())


def test_secret_scan(spark, given):
    for df, rows in both(spark, given):
        got = secret_scan.scan(df)
        assert norm(got.drop("spans", "found", "n_entropy").collect()) == norm(brute.secrets(rows))


def test_entropy_spans(spark):
    rows = [(1, "key Zx9kQ2mLp7Rt4Vb8Nc1wYd end"), (2, "see aaaaaaaaaaaaaaaaaaaaaaa1 here"), (3, "Zx9kQ2mLp7Rt4example8Nc1w"),
            (4, "a-plain-word-of-many-letters"), (5, "é Zx9kQ2mLp7Rt4Vb8Nc1wYd")]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(table(spark, rows)).collect()}
    assert got == {1: "entropy:4:26", 2: "", 3: "", 4: "", 5: "entropy:2:24"}


def test_allow_list_hides_no_keys(spark):
    keys = ["Zx9kQ2mLp7Rt4Vb8Nc_Yd", "Zx9kQ2mLp7Rt4Vb8Nc/Yd", "sample_key=Zx9kQ2mLp7Rt4Vb8Nc1wYd", "dummy=Zx9kQ2mLp7Rt4Vb8Nc1wYd==",
            "a=example_key=Zx9kQ2mLp7Rt4Vb8Nc1wYd", "Zx9kQ2mLp7Rt4Vb8Nc1wYd=example", "zx9kq2mlp7rt4vb8nc1w"]
    harmless = ["usr/lib/python3_dist_9/x_y", "key1=example_of_some_value_2b", "sample_key_number_12_for_all", "/var/log/abc_def_12/x_y"]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(table(spark, list(enumerate(keys + harmless)))).collect()}
    assert [got[i] for i in range(len(keys))] == [f"entropy:0:{len(k)}" for k in keys]
    assert [got[len(keys) + i] for i in range(len(harmless))] == [""] * len(harmless)


def entropy_spans(t):
    """All suspect candidates of a text, by definition."""
    import math
    import re
    allowed = re.compile(r"(?i:example|sample|dummy|placeholder|x{6,}|0{8,}|abcdefghij|0123456789|^[a-z]+([_/-][a-z]+)*\Z|"
                         r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\Z)|^/?[a-z0-9_]+(/[a-z0-9_]+)*\.?\Z(?<![A-Z0-9]{4})(?<![A-Za-z0-9]{4})")
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t or ""):
        s = m[0]
        if not (re.search("[0-9]", s) and re.search("[A-Za-z]", s)):
            continue
        parts = [p for p in s.split("=") if p]
        values = [p for i, p in enumerate(parts) if len(p) >= 20 or i == len(parts) - 1]
        if allowed.search(s) and all(allowed.search(v) for v in values):
            continue
        best = max(-sum(c / 20 * math.log2(c / 20) for c in Counter(s[a:a + 20]).values()) for a in range(len(s) - 19))
        if best >= (3.0 if re.fullmatch("[0-9a-fA-F]+", s) else 3.7) - 1e-12:
            out.append((m.start(), m.end()))
    return out


def test_entropy_spans_by_definition(spark, given):
    rng = np.random.default_rng(8)
    letters = list("abcdefABCDEF0123456789Zz9_/=+- ")
    rows = [(i, " ".join("".join(rng.choice(letters, rng.integers(5, 60))) for _ in range(12))) for i in range(120)]
    for df, texts in ((table(spark, rows), rows), given):
        got = secret_scan.scan(df).select("doc_id", "n_entropy", "found").collect()
        want = {i: entropy_spans(t) for i, t in texts}
        assert {r["doc_id"]: r["n_entropy"] for r in got} == {i: len(s) for i, s in want.items()}
        for r in got:
            base = [(s["start"], s["end"]) for s in r["found"] if s["kind"] != "entropy"]
            mine = [(s["start"], s["end"]) for s in r["found"] if s["kind"] == "entropy"]
            assert mine == [s for s in want[r["doc_id"]] if not any(a <= s[0] and s[1] <= b for a, b in base)]
    assert sum(map(len, (entropy_spans(t) for _, t in rows))) > 100


def test_many_matches_in_one_text(spark):
    text = "é token=abcdefgh12 " * 20_000
    got = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert got["n_assign"] == 20_000 and got["found"][-1]["end"] == len(text) - 1
    assert norm([(got["doc_id"], got["n_assign"], got["n_access"], got["n_hex"], got["base_sha256"])]) == norm(brute.secrets([(1, text)]))


def test_window_entropy_is_exact(spark):
    from pyspark.sql import functions as F
    text = "aab0cd1e2ffgh3ijklmn4opqrst5aaaaaa"
    want = 0.0
    for a in range(len(text) - 19):
        _, n = np.unique(list(text[a:a + 20]), return_counts=True)
        want = max(want, float(-(n / 20 * np.log2(n / 20)).sum()))
    got = spark.range(1).select(secret_scan.window_entropy(F.lit(text))).first()[0]
    assert abs(got - want) < 1e-9


def test_decontamination(spark, given):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    for df, rows in both(spark, given):
        for b, its in ((bench, items), (spark.createDataFrame(ITEMS, bench.select("item_id", "text").schema), ITEMS)):
            got = decontaminate.digest(decontaminate.find(df, b)).drop("n_proximity", "proximity_sha256").collect()
            assert norm(got) == norm(brute.contamination(rows, its))


def test_decontamination_without_broadcast(spark, given, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_BYTES", 0)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    df, rows = given
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = decontaminate.digest(decontaminate.find(df, bench)).drop("n_proximity", "proximity_sha256").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert norm(got) == norm(brute.contamination(rows, [(r["item_id"], r["text"]) for r in bench.collect()]))


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "b0 b1 b2 b3 b4 b5 b6 b7 b8 b9")], "item_id long, text string")
    rows = [(1, "x b0 b1 b2 b3 WRONG b5 b6 b7 b8 b9 y"), (2, "B0 b1 b2 b3 b4, b5 b6 b7 b8 b9"), (3, "b4")]
    got = {r["doc_id"]: (r["n_hit"], r["n_proximity"]) for r in decontaminate.digest(
        decontaminate.find(table(spark, rows), bench)).collect()}
    assert got[2] == (10, 0) and got[1][0] == 0 and got[3] == (0, 0)


def near_matches(rows, items, window=10, near=8):
    """(item_id, start, same) of every window of which ``near`` words, not all, are in place, per row."""
    words_of = lambda t: brute.ALNUM.findall((t or "").translate(brute.LOWER))
    wins = set()
    for item, t in items:
        w = words_of(t)
        size = min(window, len(w))
        wins |= {("" if item is None else str(item), tuple(w[a:a + size])) for a in range(len(w) - size + 1 if size else 0)}
    out = []
    for i, t in rows:
        w, places, found = words_of(t), defaultdict(list), set()
        for p, x in enumerate(w):
            places[x].append(p)
        for item, g in wins:
            same = defaultdict(int)
            for o, x in enumerate(g):
                for p in places.get(x, ()):
                    same[p - o] += 1
            found |= {(item, a, n) for a, n in same.items() if near <= n < len(g)}
        out.append((i, len(found), brute.sha(",".join(f"{m}:{a}:{n}" for m, a, n in sorted(found)))))
    return out


def test_proximity_finds_every_near_copy(spark, given):
    """Changed words may be the rarest of a window, or unknown to the corpus."""
    b = [f"b{i}" for i in range(10)]
    items = [(1, " ".join(b)), (2, "c0 c1 c2 c3 c4 c5 c6 c7 c8"), (3, "d0 d1 d2 d3 d4 d5 d6 d7"), (None, "gone " + " ".join(b[1:9]) + " never"),
             (4, "e e e e e e e e e f e e")]
    rows = [(1, "b0 b1 " * 3), (2, "e e e e e e e e e e e"), (3, "c1 c2 c3 c4 c5 c6 c7 c8"), (4, "d0 d1 d2 d3 d4 d5 d6 x"), (None, None)]
    rows += [(10 * i + j + 100, " ".join(["x", *(w if k not in (i, j) else "wrong" for k, w in enumerate(b)), "y"])) for i in range(10) for j in range(i + 1)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find(table(spark, rows), bench)
    proximity = lambda f: norm(decontaminate.digest(f).select("doc_id", "n_proximity", "proximity_sha256").collect())
    assert proximity(found) == norm(near_matches(rows, items))
    assert {r["n_proximity"] > 0 for r in found.where("row.doc_id >= 100").collect()} == {True}
    df, rows = given
    # each given text is also an item, with some of its words changed
    items = [(i, " ".join("odd" if k % 9 == 4 else w for k, w in enumerate((t or "").split()[:40]))) for i, t in rows[:40]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = near_matches(rows, items)
    assert sum(n for _, n, _ in want) > 100
    assert proximity(decontaminate.find(df, bench)) == norm(want)


def test_warc(spark, given):
    magic = "WARC/1.0\r\nWARC-Type: response\r\nX-Payload-Length: 3\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(9, "<p>é</p>"), (3, "<p>é</p>"), (4, None), (5, ""), (6, "a" + magic + "b" + magic), (7, magic), (8, "WARC/1.0\r\n"), (10, "x\r\n\r\ny")]
    df = spark.createDataFrame([(i, f"http://e/{i}\r\n", h, "c", "d") for i, h in rows], "page_id long, url string, html string, file string, off string")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = warc.roundtrip(df)
    assert norm(got.select(*cols).collect()) == norm(brute.archive(rows))
    assert {(r["record_type"], r["verified"]) for r in got.collect()} == {("response", True), ("revisit", None)}
    assert {r["chain_whole"] for r in got.collect()} == {True}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")  # records across blocks
    try:
        got = warc.roundtrip(pages).select(*cols).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert norm(got) == norm(brute.archive([(r["page_id"], r["html"]) for r in pages.collect()]))


def check_pieces(got, rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for _, t in rows]
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    unique = [i for i, _ in rows if sum(j == i for j, _ in rows) == 1]
    for (i, _), own in zip(rows, ids, strict=True):
        if i not in unique:
            continue
        at = 0
        for start, length, crc, total in sorted(pieces[i]):
            assert start == at and total == len(own)
            assert crc == zlib.crc32(np.array(own[start:start + length], "<u4").tobytes())
            at += length
        assert at == len(own)
    assert sum(r["length"] for r in got) == sum(map(len, ids))


def test_packing(spark, given):
    rows = odd_texts() + [(90, "It's WE'LL <|endoftext|> 123 İstanbul Σίσυφος ﬁne …  x étude 'tis naïve"), (91, "don't... stop!!! A.B,c;d 日本語")]
    check_pieces(packing.pack(table(spark, rows)).collect(), rows)
    df, rows = given
    got = packing.pack(df).collect()
    check_pieces(got, rows)
    sequences = {r["sequence_id"] for r in got}
    assert sum(r["length"] for r in got) > 0.9 * packing.CAPACITY * (len(sequences) - 1)


def test_word_cache_may_overflow(spark, given, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 1 << 12)
    monkeypatch.setattr(packing, "_workers", {})
    df, rows = given
    ids = packing.WordIds(packing.default_tokenizer())
    from ledgerline.llm import textops
    import pyarrow as pa
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for first, offs, data in textops.blocks(pa.array([t for _, t in rows[:60]]), 4000):
        tokens, bounds, _, _ = packing.tokenize_block(ids, data, offs)
        for k in range(len(offs) - 1):
            want = tokenizer.encode(rows[first + k][1], add_special_tokens=False).ids
            assert list(tokens[bounds[k]:bounds[k + 1]]) == [*want, packing.END_ID]


def test_hilbert_keys_visit_neighbours():
    side = np.arange(8)
    points = np.array(np.meshgrid(side, side, side)).reshape(3, -1).T
    along = points[np.argsort(packing.curve_key(points, 3))]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_empty_tables(spark):
    empty = table(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (suffix_dedup.dedup(empty), substring_dedup.dedup(empty), hash_sharding.shard(empty), line_dedup.report(empty),
               quality_rules.score(empty), jaccard_join.components_of(empty), secret_scan.scan(empty),
               decontaminate.find(empty, bench), packing.pack(empty),
               warc.roundtrip(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert df.count() == 0
    some = table(spark, [(1, "a b c"), (2, None)])
    assert [r["n_hit"] for r in decontaminate.find(some, bench).collect()] == [0, 0]


def test_clashing_columns_survive(spark):
    """Values of columns that are named like the operators' own; also where ids repeat."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for ids in ((1, 2), (1, 1), (None, 2)):
        rows = [(ids[0], "the word " * 60 + "\nthe end of it"), (ids[1], "of other " + " ".join(f"w{i}" for i in range(60)))]
        fields = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                               *[T.StructField(c, T.StringType()) for c in [*CLASHING, "_RID_", "component_id", "ln", "first", "c"]]])
        df = spark.createDataFrame([(*r, *[f"{c}{i}" for c in fields.names[2:]]) for i, r in enumerate(rows)], fields)
        for f in (lambda d: quality_rules.filter_documents(d, rules=()), line_dedup.filter_lines, jaccard_join.keep_one,
                  lambda d: decontaminate.remove(d, items), lambda d: periodic_runs.collapse(d)):
            out = f(df)
            assert out.columns == df.columns
            got = [tuple(r)[2:] for r in out.collect()]
            assert got and set(got) <= {tuple(r)[2:] for r in df.collect()}
    found = jaccard_join.components_of(spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "z")], "doc_id string, text string"))
    assert norm(tuple(r) for r in found.collect()) == norm([("a", 1, "a"), ("b", 1, "a"), (None, 1, None)])


def test_warc_of_another_writer(spark, tmpdir_path):
    """Standard headers alone, other record types, a false digest, a broken chain."""
    import base64
    import hashlib
    import os

    def record(kind, block, **more):
        head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in more.items())
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block.encode())}\r\n\r\n{block}\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    whole = (record("warcinfo", "software: other") + record("response", http + "body é", Content_Type="application/http; msgtype=response")
             + record("response", http + "lied", Content_Type="application/http", WARC_Payload_Digest="sha1:AAAA", X_Page_Id=7)
             + record("resource", "plain", WARC_Payload_Digest="sha256:00"))
    sha = lambda x: base64.b32encode(hashlib.sha1(x.encode()).digest()).decode()
    folder = os.path.join(tmpdir_path, "whole")
    os.makedirs(folder)
    with open(f"{folder}/a.warc", "w", newline="") as fh:
        fh.write(whole)
    got = [(r["record_type"], r["payload_bytes"], r["payload_digest"], r["page_id"], r["verified"])
           for r in warc.read_archive(spark, folder).orderBy("offset").collect()]
    assert got == [("warcinfo", 15, sha("software: other"), None, None), ("response", 7, sha("body é"), None, None),
                   ("response", 4, sha("lied"), 7, False), ("resource", 5, sha("plain"), None, None)]
    with open(f"{folder}/b.warc", "w", newline="") as fh:
        fh.write(record("response", http + "x").replace(f"Content-Length: {len(http) + 1}", "Content-Length: 99") + record("response", http + "lost"))
    with pytest.raises(ValueError, match="b.warc"):
        warc.read_archive(spark, folder)
    loose = warc.read_archive(spark, folder, strict=False)
    assert {r["file"][-6:]: r["chain_whole"] for r in loose.collect()} == {"a.warc": True, "b.warc": False}


def test_registered_names():
    names = list(queries.registry())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_later_directory_rounds_take_few_levels(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{i:0100d}") for i in range(2000)], "doc_id long, text string")
    limit = 2000 * 100 // 23  # a bucket needs four or five bits
    want = sorted(map(tuple, hash_sharding.shard(docs, limit).collect()))
    made, kept = [], hash_sharding.checkpoint

    def counted(df):
        out = kept(df)
        made.append(out.count() if "fits" in out.columns else 0)
        return out

    monkeypatch.setattr(hash_sharding, "LEVELS", 4)
    monkeypatch.setattr(hash_sharding, "checkpoint", counted)
    assert sorted(map(tuple, hash_sharding.shard(docs, limit).collect())) == want
    rounds = [n for n in made if n]
    assert len(rounds) == 2 and rounds[0] == 31
    assert rounds[1] <= 16 * 7, rounds  # two levels below each bucket, not four
