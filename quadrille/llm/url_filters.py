"""URL filters: allow and block entries held in a trie over reversed host labels and path segments.

An entry is a host and a path prefix. It fits a URL when the URL's host is the entry's host or one of
its subdomains and the URL's path starts with the entry's path; the longest fitting entry decides.

The trie first walks the host from its last label to its first (``org``, ``example``, ``www``). A node
where an entry's host ends holds a second trie over path segments: all segments of the entry but its
last must be equal, and the last is a prefix of the URL's segment at that depth (an entry that ends in
``/`` has an empty last segment, which is a prefix of any). A walk therefore costs one step per label
and per segment, however many entries there are.

Entries of a counted size are broadcast as one trie. Longer lists are met by a shuffled equi-join on the
same two walks (host suffix, leading segments); both ways give the same verdicts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, fresh

#: Entries up to this number travel as one broadcast trie (some 100 bytes each); more go through the join.
TRIE_RULES = 200_000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Trie:
    """Entries by reversed host labels, then by path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.hosts: dict = {}
        for rule in rules:
            node = self.hosts
            for label in reversed(rule.host.split(".")):
                node = node.setdefault("." + label, {})
            segments = node.setdefault("/", {})
            *whole, last = rule.path.split("/")
            for segment in whole:
                segments = segments.setdefault("/" + segment, {})
            entries = segments.setdefault("", {})
            held = entries.get(last)
            if held is None or (held.verdict, rule.verdict) == ("allow", "block"):
                entries[last] = rule

    def find(self, host: str, path: str) -> Rule | None:
        """The longest entry that fits. Fitting entries are suffixes of one host and prefixes of one path,
        so equally long ones differ in both: then the longer host wins. Of equal entries, block wins."""
        best, best_rank, node = None, (-1, -1), self.hosts
        parts = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("." + label)
            if node is None:
                break
            segments = node.get("/")
            for part in parts:
                if segments is None:
                    break
                entries = segments.get("")
                if entries:
                    for length in range(len(part) + 1):
                        rule = entries.get(part[:length])
                        if rule is not None:
                            rank = (len(rule.host) + len(rule.path), len(rule.host))
                            if rank > best_rank:
                                best, best_rank = rule, rank
                segments = segments.get("/" + part)
        return best


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty where the host is missing."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_trie(parts: DataFrame, rules: list[Rule], rule: str, verdict: str, default: str) -> DataFrame:
    shared = parts.sparkSession.sparkContext.broadcast(Trie(rules))
    schema = parts.select("*", F.lit(None).cast("string").alias(rule), F.lit(None).cast("string").alias(verdict)).schema
    at_host, at_path = (parts.columns.index(n) for n in parts.columns[-2:])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, memo = shared.value, {}
        for batch in batches:
            texts, verdicts = [], []
            for host, path in zip(batch.column(at_host).to_pylist(), batch.column(at_path).to_pylist()):
                key = (host, path)
                if key not in memo:
                    if len(memo) > 100_000:
                        memo.clear()
                    found = trie.find(host, path)
                    memo[key] = (found.text, found.verdict) if found else (None, default)
                text, said = memo[key]
                texts.append(text)
                verdicts.append(said)
            columns = [*batch.columns, pa.array(texts, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, rule, verdict])

    return parts.mapInArrow(judge, schema)


def _by_join(parts: DataFrame, rules: DataFrame, host: str, path: str, rule: str, verdict: str, default: str) -> DataFrame:
    """The same walks as an equi-join: one key per host suffix and number of leading segments."""
    entries = rules.select(
        F.col("host").alias("__suffix"),
        F.slice(F.split("path", "/", -1), F.lit(1), F.size(F.split("path", "/", -1)) - 1).alias("__whole"),
        F.element_at(F.split("path", "/", -1), -1).alias("__last"),
        F.col("path").alias("__rule_path"),
        F.col("verdict").alias("__verdict"),
    )
    number = fresh(parts, "__url")
    urls = parts.select(host, path).distinct()
    labels, segments = F.split(host, r"\.", -1), F.split(path, "/", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    depths = F.sequence(F.lit(0), F.size(segments) - 1)
    walks = urls.withColumn("__suffix", F.explode(suffixes)).withColumn(number, F.explode(depths))
    walks = walks.withColumn("__whole", F.slice(segments, F.lit(1), F.col(number)))
    walks = walks.withColumn("__part", F.element_at(segments, F.col(number) + 1))
    met = walks.join(entries, ["__suffix", "__whole"]).where(F.startswith("__part", "__last"))
    rank = F.struct(
        (F.length("__suffix") + F.length("__rule_path")).alias("a"),
        F.length("__suffix").alias("b"),
        (F.col("__verdict") == "block").alias("c"),
        F.concat("__suffix", "__rule_path").alias("rule"),
        F.col("__verdict").alias("verdict"),
    )
    best = met.groupBy(host, path).agg(F.max(rank).alias("__best"))
    out = parts.join(best, [host, path], "left")
    named = [F.col("__best.rule").alias(rule), F.coalesce("__best.verdict", F.lit(default)).alias(verdict)]
    return out.select(*parts.columns, *named)


def judge_urls(
    df: DataFrame,
    rules: list[Rule] | DataFrame,
    url: str = "url",
    default: str = "allow",
    trie_rules: int = TRIE_RULES,
    names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict"),
) -> DataFrame:
    """``df`` with the host, the path, the entry that decides (null if none) and the verdict of every URL.

    A null URL or one without ``://`` has an empty host and path; no entry fits it, so it gets
    ``default``, as does any URL that no entry fits. Of equal entries block wins. Rows are neither
    dropped nor merged: repeated rows get the same verdict each. Columns of ``df`` that are called
    like the four new ones are replaced; all others stay. An empty table stays empty.
    ``rules`` may be a table (host, path, verdict); entries with a null host or path are left out.
    """
    host, path, rule, verdict = names
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    parts = df.select(*[F.col(f"`{c}`") for c in kept], host_of(F.col(url)).alias(host), path_of(F.col(url)).alias(path))
    if isinstance(rules, DataFrame):
        rows = rules.select("host", "path", "verdict").where("host is not null and path is not null and verdict is not null")
        first = rows.limit(trie_rules + 1).collect()
        if len(first) > trie_rules:
            return _by_join(parts, rows, host, path, rule, verdict, default)
        rules = [Rule(*r) for r in first]
    elif len(rules) > trie_rules:
        rows = df.sparkSession.createDataFrame(rules, "host string, path string, verdict string")
        return _by_join(parts, rows, host, path, rule, verdict, default)
    return _by_trie(parts, list(rules), rule, verdict, default)
