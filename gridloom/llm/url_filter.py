"""URL filter by a trie over reversed host labels and path segments.

Rules are (action, host, path) with action ``allow`` or ``block``.  A rule
fits its host and every subdomain of it, if the URL's path starts with the
rule's path.  Of the fitting rules the longest wins: more host labels first,
then the longer path; of an allow and a block rule with the same host and
path the block wins.

``UrlTrie`` holds the host labels in reverse (``net`` -> ``example``), and in
each host node the rules' path segments.  A rule's last segment matches as a
prefix of the URL's segment at that depth, so ``/en`` fits ``/english`` and
``/en/`` does not.

Up to ``MAX_TRIE_RULES`` rules the trie is broadcast.  Larger rule sets go
through ``match_by_join`` (rules as a DataFrame, equi-join on the host
suffixes), which gives the same result without a broadcast.

Edge cases: a null URL or one without ``://`` has empty host and path; such
URLs, empty hosts and empty paths fit no rule (a rule's path starts with
``/``) and get the default verdict.  Repeated rows are judged each on its
own, URLs of any length whole; of equal rules with both verdicts the block
wins; an empty table gives no rows.  Columns of the input keep their names; the operator's columns replace
input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import lower_ascii, null_safe

MAX_TRIE_RULES = 200_000

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(entries: Iterable[tuple[str, str]]) -> list[Rule]:
    """``("block", "example.com/de/")`` -> Rule; a rule without a path gets
    ``/``.  Hosts are compared lower-case (A-Z)."""
    rules = []
    for action, entry in entries:
        if action not in (ALLOW, BLOCK):
            raise ValueError(f"unknown action {action!r}")
        host, slash, path = entry.partition("/")
        if not host:
            raise ValueError(f"rule {entry!r} has no host")
        rules.append(Rule(action, host.lower(), slash + path or "/"))
    return rules


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


class UrlTrie:
    """Host labels in reverse, then path segments; ``find`` walks both."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {"kids": {}, "path": None}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node["kids"].setdefault(label, {"kids": {}, "path": None})
            if node["path"] is None:
                node["path"] = {"kids": {}, "ends": {}}
            leaf = node["path"]
            *whole, last = rule.path.split("/")
            for segment in whole:
                leaf = leaf["kids"].setdefault(segment, {"kids": {}, "ends": {}})
            held = leaf["ends"].get(last)
            if held is None or rule.action == BLOCK:
                leaf["ends"][last] = (rule.text, rule.action)

    @staticmethod
    def _deepest(leaf: dict, segments: list[str]):
        """The rule with the longest path in one host's path trie."""
        best = None
        for segment in segments:
            ends = leaf["ends"]
            fits = [end for end in ends if segment.startswith(end)] if len(ends) < 9 else [
                segment[:k] for k in range(len(segment) + 1) if segment[:k] in ends]
            if fits:
                best = ends[max(fits, key=len)]
            leaf = leaf["kids"].get(segment)
            if leaf is None:
                break
        return best

    def find(self, host: str, path: str):
        """(rule text, action) of the longest fitting rule, or None."""
        best, segments, node = None, path.split("/"), self.root
        for label in reversed(host.split(".")):
            node = node["kids"].get(label)
            if node is None:
                break
            if node["path"] is not None:
                best = self._deepest(node["path"], segments) or best
        return best


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url",
               default: str = ALLOW) -> DataFrame:
    """``pages`` plus host, path, rule (text or null) and verdict."""
    parts = pages.withColumns({"host": null_safe(url_host(F.col(url_col))),
                               "path": null_safe(url_path(F.col(url_col)))})
    if len(rules) > MAX_TRIE_RULES:
        return match_by_join(parts, rules, default)
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = trie.value.find
        found = [find(h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return (parts.withColumn("_judged", judge("host", "path"))
            .withColumns({"rule": F.col("_judged.rule"), "verdict": F.col("_judged.verdict")})
            .drop("_judged"))


def match_by_join(parts: DataFrame, rules: list[Rule], default: str = ALLOW) -> DataFrame:
    """The same verdicts for any number of rules: each distinct (host, path)
    is joined to the rules on its host suffixes, the longest fitting rule is
    picked by a partial aggregate, and joined back."""
    spark = parts.sparkSession
    table = spark.createDataFrame(
        [(r.action, r.host, r.path, r.text, len(r.host.split("."))) for r in rules],
        "action string, suffix string, rule_path string, rule_text string, labels int")
    keys = parts.select("host", "path").distinct()
    suffixes = F.expr("transform(sequence(1, size(split(host, '[.]'))), "
                      "i -> substring_index(host, '.', -i))")
    best = (keys.withColumn("suffix", F.explode(suffixes))
            .join(table, "suffix")
            .filter(F.col("path").startswith(F.col("rule_path")))
            .groupBy("host", "path")
            .agg(F.max(F.struct("labels", F.length("rule_path").alias("size"),
                                (F.col("action") == BLOCK).alias("blocks"),
                                F.col("rule_text").alias("rule"),
                                F.col("action").alias("verdict"))).alias("best"))
            .select("host", "path", F.col("best.rule").alias("rule"),
                    F.col("best.verdict").alias("verdict")))
    return (parts.drop("rule", "verdict").join(best, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))
