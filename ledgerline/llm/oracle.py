"""DuckDB SQL for the queries of this package that SQL can express. The others
(op1, op6, op9, op11, op13 and the pipeline) are tested against brute force."""

from __future__ import annotations

# Fixed values, stated here and not taken from the operators: a wrong one there shows.
LIMIT_BYTES = 128 << 10
STOP_WORDS = (
    "the and of to in is that it for on as with was be by at are this "
    "de la le et les des un en du une que est pour dans qui au "
    "der die und das den von zu mit ist ein nicht auf für im "
    "el los y las se del por con una para su al es").split()
QUALITY = """NOT base_failed AND n_words BETWEEN 50 AND 1000000000
    AND (unspaced OR (word_chars >= 2 * n_words AND word_chars <= 16 * n_words)) AND n_symbols <= 0.5::DOUBLE * n_words
    AND (unlisted OR n_stop_words >= 0.01::DOUBLE * n_words) AND n_upper_words <= 0.5::DOUBLE * n_words
    AND n_dup_lines <= 0.5::DOUBLE * n_lines AND n_repeat_words <= 0.5::DOUBLE * n_words AND n_bar_words <= 0.3::DOUBLE * n_words"""
WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op2() -> str:
    return f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
spots AS (SELECT *, h >> (60 - depth)::BIGINT AS prefix FROM d, (SELECT unnest(range(0, 61)) AS depth)),
buckets AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, min(h) = max(h) AS single FROM spots GROUP BY ALL),
fits AS (SELECT * FROM buckets WHERE shard_bytes <= {LIMIT_BYTES} OR single),
placed AS (SELECT spots.doc_id, spots.h, spots.n_bytes, f.depth, f.shard_bytes,
    row_number() OVER (PARTITION BY spots.doc_id, spots.h ORDER BY f.depth) AS r FROM spots JOIN fits f USING (depth, prefix))
SELECT doc_id, n_bytes::BIGINT AS n_bytes, depth::INTEGER AS shard_depth, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard_prefix,
    shard_bytes, shard_bytes > {LIMIT_BYTES} AS oversized FROM placed WHERE r = 1"""


def op3() -> str:
    return f"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS ln, unnest(ls) AS line FROM l),
w AS (SELECT doc_id, ln, line, regexp_extract_all(line, '{WORD}') AS ws FROM lines),
t AS (SELECT DISTINCT doc_id, ln, unnest(ws) AS g FROM w),
n AS (SELECT doc_id, ln, count(*) AS n FROM t GROUP BY ALL),
shared AS (SELECT x.doc_id AS xd, x.ln AS xl, y.doc_id AS yd, y.ln AS yl, count(*) AS both_n FROM t x JOIN t y ON x.g = y.g
    AND (x.doc_id < y.doc_id OR (x.doc_id = y.doc_id AND x.ln < y.ln)) GROUP BY ALL),
gone AS (SELECT DISTINCT yd AS doc_id, yl AS ln FROM shared JOIN n a ON a.doc_id = xd AND a.ln = xl JOIN n b ON b.doc_id = yd AND b.ln = yl
    WHERE 100 * both_n >= 80 * (a.n + b.n - both_n)),
per AS (SELECT doc_id, count(*) AS c, string_agg(ln::VARCHAR, ',' ORDER BY ln) AS removed FROM gone GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(c, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM l LEFT JOIN per USING (doc_id)"""


def op4() -> str:
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(STOP_WORDS)))
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
    lower(regexp_extract(coalesce(lang, ''), '^[A-Za-z]*')) AS code FROM documents),
g AS (SELECT doc_id, i, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS t FROM (
    SELECT doc_id, ws, unnest(range(0, len(ws) - 2)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM g) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, [s FOR s IN string_split(x, chr(10)) IF regexp_matches(s, '[^\\x20\\x09-\\x0D]')] AS ls FROM w),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(s) FOR s IN ws]), 0)::BIGINT AS word_chars,
    length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
    code NOT IN ('en', 'fr', 'de', 'es', '', 'und', 'unknown') AS unlisted, code IN ('zh', 'ja', 'th', 'lo', 'km', 'my', 'bo') AS unspaced,
    len([s FOR s IN ws IF lower(s) IN ({words})]) AS n_stop_words,
    len([s FOR s IN ws IF length(s) > 1 AND s = upper(s) AND s <> lower(s)]) AS n_upper_words,
    len([s FOR s IN ws IF s = '|']) AS n_bar_words
    FROM w JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {QUALITY} AS kept FROM b"""


def op5() -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
    ELSE ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] END AS g
    FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 2, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT r.a AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a"""


def op7() -> str:
    lowered = LOWERED.format("coalesce(text, '')")
    return f"""
WITH iw AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, regexp_extract_all({lowered}, '{ALNUM}') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, size, array_to_string(ws[i + 1:i + size], ' ') AS k FROM (
    SELECT item_id, ws, least(len(ws), 10) AS size, unnest(range(0, len(ws) - least(len(ws), 10) + 1)) AS i FROM iw WHERE len(ws) > 0)),
dw AS (SELECT doc_id, regexp_extract_all({lowered}, '{ALNUM}') AS ws FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (SELECT doc_id, i, size, array_to_string(ws[i + 1:i + size], ' ') AS k FROM (
    SELECT doc_id, ws, size, unnest(range(0, greatest(len(ws) - size + 1, 0))) AS i FROM dw, sizes)),
found AS (SELECT doc_id, i, size, item_id FROM grams JOIN win USING (size, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (
    SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id),
wide AS (SELECT item_id, size, string_split(k, ' ') AS ws, row_number() OVER () AS w FROM win WHERE size > 8),
spots AS (SELECT item_id, size, w, unnest(ws) AS word, unnest(range(size)) AS o FROM wide),
places AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM dw),
near AS (SELECT DISTINCT doc_id, item_id, start, same FROM (
    SELECT doc_id, item_id, size, w, p - o AS start, count(*) AS same FROM places JOIN spots USING (word) GROUP BY ALL)
    WHERE same >= 8 AND same < size),
prox AS (SELECT doc_id, count(*) AS n, string_agg(item_id || ':' || start || ':' || same, ',' ORDER BY item_id, start, same) AS ids FROM near GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
    sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated, coalesce(p.n, 0)::BIGINT AS n_proximity,
    sha256(coalesce(p.ids, '')) AS proximity_sha256
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN items t USING (doc_id) LEFT JOIN prox p USING (doc_id)"""


def op8() -> str:
    digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> {}) & 31)::INTEGER + 1, 1)"
    four = " || ".join(digit.format(s) for s in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
parts AS (SELECT page_id, i, ('0x' || substr(hex, 5 * i + 1, 5))::BIGINT AS v FROM p, (SELECT unnest(range(8)) AS i)),
b AS (SELECT page_id, string_agg({four}, '' ORDER BY i) AS payload_digest FROM parts GROUP BY page_id),
f AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to FROM f JOIN b USING (page_id)"""


def op10() -> str:
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 20], ' ') AS k FROM (
    SELECT doc_id, ws, unnest(range(0, len(ws) - 19)) AS i FROM w)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM (
    SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def op12() -> str:
    host = "coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')"
    return f"""
WITH rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, {LOWERED.format(host)} AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
fits AS (SELECT host, path, h || p AS rule, v, row_number() OVER (PARTITION BY host, path ORDER BY length(h) DESC, length(p) DESC) AS r
    FROM (SELECT DISTINCT host, path FROM u) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, u.host, u.path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM fits WHERE r = 1) f USING (host, path)"""


def registry() -> dict[str, str]:
    return {"op2_hash_sharding": op2(), "op3_line_dedup": op3(), "op4_quality_rules": op4(), "op5_jaccard_join": op5(),
            "op7_decontaminate": op7(), "op8_warc": op8(), "op10_substring_dedup": op10(), "op12_url_filter": op12()}
