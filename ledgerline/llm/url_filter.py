"""URL filter: a trie over reversed host labels and path segments.

A rule is (host, path, verdict). It fits a URL whose host is the rule's host or
one of its subdomains and whose path starts with the rule's path. Of the rules
that fit, the one with the longest host wins, then the one with the longest
path; if the same host and path is listed with both verdicts, block wins. A URL
that no rule fits gets the ``default`` verdict.

Method. The rules become a trie whose edges are host labels from the right
(``com``, ``example``, ``www``) and below them path segments; a last segment
without a closing slash is kept as a text that the URL's segment must start
with. The trie is broadcast and every URL walks it: down the labels, then from
the deepest host back up, down the path; the first node with a rule on the way
back is the longest match.

The broadcast has a proven bound: the rules' bytes are summed first, and above
``MAX_TRIE_BYTES`` nothing is collected; then the distinct (host, path)
pairs are joined with the rules on their own host suffixes and path prefixes (of
the lengths that occur among the rules), and the best match is an aggregate.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower
case. Path: from there up to ``?``, ``#`` or the end. Defined results: a null
URL or one without ``://`` has empty host and path, and gets the default unless
a rule has an empty host, which fits every host; rules with a null host or
path read it as empty, rules with another verdict than allow or block raise.
One result row for each input row, whatever repeats; other columns travel in
the struct ``row``, so no name clashes. An empty rule table leaves the default.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import lower_ascii, rows_where, ship_package

ALLOW, BLOCK = "allow", "block"
#: Largest rule table, in bytes of its hosts and paths, whose trie is broadcast.
MAX_TRIE_BYTES = 32 << 20

RULES = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nodes are [edges, verdict or None, path root or None, partial segments]."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root = self._node()
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node[0].setdefault(label, self._node())
            if node[2] is None:
                node[2] = self._node()
            node = node[2]
            *whole, last = path.split("/")
            for segment in whole:
                node = node[0].setdefault(segment, self._node())
            if last:
                node = node[3].setdefault(last, self._node())
            node[1] = BLOCK if BLOCK in (node[1], verdict) else ALLOW

    @staticmethod
    def _node() -> list:
        return [{}, None, None, {}]

    @staticmethod
    def _in_path(node: list, path: str) -> tuple[int, str] | None:
        """Length and verdict of the longest rule path that ``path`` starts with."""
        best, at = None, 0
        while True:
            if node[1]:
                best = at, node[1]
            end = path.find("/", at)
            segment = path[at:] if end < 0 else path[at:end]
            for n in range(len(segment), 0, -1) if node[3] else ():
                if segment[:n] in node[3]:
                    best = at + n, node[3][segment[:n]][1]
                    break
            node = node[0].get(segment) if end >= 0 else None
            if node is None:
                return best
            at = end + 1

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule text and verdict of the longest match, or None."""
        nodes, node = [("", self.root)], self.root
        if host:
            end = len(host)
            while node is not None:
                dot = host.rfind(".", 0, end)
                node = node[0].get(host[dot + 1:end])
                if node is not None:
                    nodes.append((host[dot + 1:], node))
                if dot < 0:
                    break
                end = dot
        for suffix, node in reversed(nodes):
            if node[2] is not None and (hit := self._in_path(node[2], path)):
                return suffix + path[:hit[0]], hit[1]
        return None


def _walk(trie, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            hits = [trie.value.match(h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([h[0] for h in hits], pa.string()), pa.array([h[1] for h in hits], pa.string())],
                [*batch.schema.names, "rule", "verdict"])
    return run


def _by_join(parts: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same matches by joins: for rule tables too large to broadcast."""
    rules = rules.groupBy("host", "path").agg(F.min(F.col("verdict") == ALLOW).alias("allowed"))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]  # path lengths that occur: a handful
    labels = F.split("host", r"\.")
    suffixes = F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)]) if lengths
                        else F.array().cast("array<string>"), lambda p: p.isNotNull())
    tried = (parts.select("host", "path").distinct().withColumn("h", F.explode(F.array_distinct(suffixes))).withColumn("p", F.explode(prefixes))
             .join(rules.select(F.col("host").alias("h"), F.col("path").alias("p"), "allowed"), ["h", "p"]))
    best = tried.groupBy("host", "path").agg(F.max(F.struct(
        F.length("h"), F.length("p"), F.concat("h", "p").alias("rule"), "allowed")).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(
        "row", "host", "path", "best.rule",
        F.when(F.col("best").isNull(), F.lit(default)).otherwise(F.when(F.col("best.allowed"), ALLOW).otherwise(BLOCK)).alias("verdict"))


def judge(docs: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW,
          max_trie_bytes: int = MAX_TRIE_BYTES, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the struct ``row`` of its columns (``keep``:
    only those), ``host``, ``path``, ``rule`` (host and path of the rule, or
    null) and ``verdict``. ``rules`` has the columns host, path and verdict."""
    carried = [c for c in docs.columns if keep is None or c in keep]
    url = F.col(f"`{url_col}`")
    parts = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))
    rules = rules.select(lower_ascii(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                         F.when(F.col("verdict").isin(ALLOW, BLOCK), F.col("verdict")).otherwise(
                             F.raise_error(F.lit("a rule's verdict is allow or block"))).alias("verdict"))
    held = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).first()[0] or 0
    if held > max_trie_bytes:
        return _by_join(parts, rules, default)
    ship_package(docs.sparkSession)
    trie = docs.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in rules.collect()]))
    out = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return parts.mapInArrow(_walk(trie, default), out)


def keep_allowed(docs: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows of ``docs`` whose URL is allowed, with their columns."""
    return rows_where(judge(docs, rules, url_col, default), F.col("verdict") == ALLOW)
