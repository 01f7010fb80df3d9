"""Periodic runs, URL filter and whitening against brute force."""

import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import periodic_runs, queries, textops, url_filter, whitening
from tests.conftest import SF_SMALL
from tests.llm.brute import WORD, sha
from tests.llm.fixtures import CLASHING, norm, odd_texts, table


def runs_by_definition(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            cut = w[s:s + n]
            if n >= max(6, 4 * q) and all(any(cut[k] != cut[k + r] for k in range(n - r)) for r in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_texts():
    rng = random.Random(9)
    rows = [(100, "a " * 5), (101, "a " * 6), (102, "a b " * 4), (103, "a b " * 3 + "a"), (104, "x a b a b a b a b y"),
            (105, "a " * 30 + "b " + "a " * 30 + "b " + "a " * 30 + "b " + "a " * 30 + "b"), (106, "a b c d e f g h i\n" * 4)]
    for k in range(60):
        w = []
        while len(w) < 60 * (k % 7):
            unit = [f"w{rng.randrange(rng.choice([2, 40]))}" for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 33, 64, 70]))]
            w += (unit * 6)[:rng.randint(len(unit), 6 * len(unit))] + [f"z{rng.randrange(99)}" for _ in range(rng.randrange(4))]
        rows.append((200 + k, rng.choice([" ", "\t", "  \n"]).join(w)))
    return rows


def test_periodic_runs(spark):
    rows = odd_texts() + periodic_texts()
    got = periodic_runs.find(table(spark, rows)).collect()
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        runs = runs_by_definition(w) if len(w) < 3000 else None
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None) if runs is not None else None
        want.append((i, len(w), runs, best, collapsed(w, runs) if runs is not None else None))
    show = lambda r: r and tuple(r)
    mine = [(r["row"]["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], show(r["best"]), r["collapsed"]) for r in got]
    pairs = list(zip(sorted(mine, key=str), sorted(((a, b, [] if c is None else c, d, e) for a, b, c, d, e in want), key=str), strict=True))
    assert len(pairs) == len(rows)
    assert sorted(map(str, (m for m in mine if m[1] < 3000))) == sorted(map(str, (w for w in want if w[1] < 3000)))
    assert sum(len(m[2]) for m in mine) > 60


def test_periodic_runs_of_long_and_periodic_blocks():
    rng = np.random.default_rng(2)
    base = textops.mix(rng.integers(1, 50, 900).astype(np.uint64))
    ids = np.concatenate([np.tile(base, 5), textops.mix(np.arange(1000, 1100, dtype=np.uint64)), np.tile(base[:1], 5000)])
    got = periodic_runs.runs_of(ids, np.array([0, len(ids)])).tolist()
    assert [0, 4500, 900] in got and [4600, 9600, 1] in got
    assert len(periodic_runs.runs_of(ids[:0], np.array([0, 0, 0]))) == 0


def test_collapse_keeps_columns_and_texts_without_runs(spark):
    rows = [(1, "one  two\tthree"), (2, "a b " * 9), (None, None)]
    got = periodic_runs.collapse(table(spark, rows))
    assert got.columns == ["doc_id", "text", *CLASHING]
    assert norm(got.select("doc_id", "text").collect()) == norm([(1, "one  two\tthree"), (2, "a b"), (None, None)])
    assert {r["rid"] for r in got.collect()} == {None if CLASHING.index("rid") % 2 else "rid"}


def test_op11_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, t in docs:
        w = WORD.findall(t or "")
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        runs = [r for r in runs_by_definition(w)] if len(w) < 2500 or h % 10 == 0 else None
        if runs is None:
            continue
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        want.append((i, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs))))
    ids = {w[0] for w in want}
    got = queries.op11_periodic_runs(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = got.collect()
    assert len(got) == len(docs) and len(ids) > 150
    assert norm(r for r in got if r["doc_id"] in ids) == norm(want)
    assert sum(1 for w in want if w[1]) > 10


URLS = [None, "", "no scheme", "http://", "http://COM", "http://com/", "https://a.com/x?y#z", "x://example.com/en/1", "x://Www.Example.com/en/1",
        "x://m.www.example.com/en/?q", "x://www.example.com/en", "x://net/es/", "x://a.net/es", "x://a.net/fr/x/es/", "x://anet/fr/",
        "x://u:p@a.com:80/en/", "a://b://example.com/en/", "x://.com/", "x://a..com//", "x://example.com/en//a\nb", "x://com./", "x://comcom/"] * 2
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("net", "/fr/", "block"), ("a.com", "/x", "block"), ("a.com", "/x", "allow"), ("EXAMPLE.com", "/en/12", "allow"), ("com", None, "block")]


def by_definition(url, rules, default):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h), len(p), h + p, v) for h, p, v in ((h.lower() if h else "", p or "", v) for h, p, v in rules)
            if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: (f[0], f[1], f[3] == "block"), default=(0, 0, None, default))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("limit", [url_filter.MAX_TRIE_BYTES, 0])
@pytest.mark.parametrize("rules", [RULES, RULES + [("", "", "block"), (None, "/en/", "allow")], RULES[:5], []])
def test_url_filter(spark, rules, limit):
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = url_filter.judge(pages, spark.createDataFrame(rules, url_filter.RULES), default="block" if rules else "allow", max_trie_bytes=limit)
    want = [(i, *by_definition(u, rules, "block" if rules else "allow")) for i, u in enumerate(URLS)]
    assert norm(got.select("row.page_id", "host", "path", "rule", "verdict").collect()) == norm(want)


def test_url_filter_keeps_columns_and_checks_verdicts(spark):
    pages = spark.createDataFrame([(1, "x://a.net/es/", "mine"), (2, "x://b.com/", "mine")], "page_id long, url string, host string")
    kept = url_filter.keep_allowed(pages, spark.createDataFrame(RULES[:5], url_filter.RULES))
    assert [tuple(r) for r in kept.collect()] == [(2, "x://b.com/", "mine")]
    with pytest.raises(Exception, match="allow or block"):
        url_filter.judge(pages, spark.createDataFrame([("com", "/", "maybe")], url_filter.RULES)).collect()
    empty = url_filter.judge(pages.where("false"), spark.createDataFrame(RULES, url_filter.RULES))
    assert empty.count() == 0


def whitened_by_definition(vectors, k=4):
    x = [None if v is None or any(c is None or not math.isfinite(c) for c in v) else tuple(math.floor(256 * c) for c in v) for v in vectors]
    fit = np.array(sorted({v for v in x if v is not None}), np.int64)
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s) / n
    _, spread, axes = np.linalg.svd(centred, full_matrices=False)
    return x, n, s, spread[:k] ** 2 / n, axes[:k].T, float((spread ** 2).sum() / n)


def check_whitened(rows, ids, vectors, k=4):
    x, n, s, values, axes, trace = whitened_by_definition(vectors, k)
    by = {}
    for r in rows:
        by.setdefault((r["id"], r["component"]), []).append(r)
    at = [i for i, v in enumerate(x) if v is not None]
    assert len(rows) == len(at) * len(values)
    signs = {}
    for i in at:
        want = (np.array(x[i]) * n - s) / n @ axes / np.sqrt(values)
        for c in range(len(values)):
            r = by[ids[i], c + 1][0]
            assert r["n"] == n and int(r["deviation"]) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s, strict=True))
            assert abs(r["explained"] - values[c] / trace) < 1e-9
            if abs(want[c]) > 1e-3:
                assert abs(abs(r["whitened"]) - abs(want[c])) < 1e-6 * max(1, abs(want[c]))
                signs.setdefault(c, set()).add(np.sign(r["whitened"]) == np.sign(want[c]))
            assert r["identity_error"] < 1e-4
    assert all(len(v) == 1 for v in signs.values())


def test_op13_query(spark):
    given = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got = queries.op13_whitening(spark, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.withColumnRenamed("vec_id", "id").collect()
    check_whitened(rows, [r["vec_id"] for r in given], [r["embedding"] for r in given])


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, (60, 3)) @ rng.normal(0, 1, (3, 6)) * [1, 50, 1, 0.1, 0, 900]
    vectors = [[float(c) for c in v] for v in base] + [[float(c) for c in base[0]]] * 5
    vectors += [None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [-0.0] * 6, [0.0] * 6]
    df = spark.createDataFrame([(i, v, "c") for i, v in enumerate(vectors)], "id long, embedding array<double>, n string").repartition(5)
    got = whitening.whiten(df)
    assert {r["row"]["n"] for r in got.collect()} == {"c"}
    rows = got.select("row.id", *[c for c in got.columns if c != "row"]).collect()
    check_whitened(rows, list(range(len(vectors))), vectors, 4)


def test_whitening_without_variance_and_large_numbers(spark):
    kind = "id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, kind)).collect() == []
    line = spark.createDataFrame([(1, [0.0, 1e12]), (2, [0.0, -3e12]), (None, [0.0, 7.0])], kind)
    got = whitening.whiten(line).collect()
    assert [r["component"] for r in got] == [1, 1, 1]
    x = {1: math.floor(256 * 1e12), 2: math.floor(-256 * 3e12), None: 1792}
    s = sum(x.values())
    assert {r["row"]["id"]: int(r["deviation"]) for r in got} == {i: (3 * v - s) ** 2 for i, v in x.items()}
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], kind)).collect()


def test_packing_of_grid_vectors_is_canonical():
    x = np.array([[0, 127], [0, 128], [-40000, 3], [2 ** 40, -1], [1, 2]], np.int64)
    assert [int(p[:1]) for p in whitening._pack(x)] == [1, 2, 4, 8, 1]
    assert (whitening._unpack(whitening._pack(x)) == x).all()


def test_schemas(spark):
    want = {"op11_periodic_runs": "doc_id:bigint,n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,"
                                  "runs_sha256:string,collapsed_sha256:string",
            "op12_url_filter": "page_id:bigint,host:string,path:string,rule:string,verdict:string",
            "op13_whitening": "vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double"}
    for name, schema in want.items():
        assert queries.registry()[name](spark, SF_SMALL).schema.simpleString() == f"struct<{schema}>", name
