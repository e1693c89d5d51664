"""URL filters: a trie over reversed host labels and path segments, sent to the tasks once.

A rule is (action, host, path). It fits its host and every subdomain when the path of the URL starts with the
path of the rule. Of several that fit, the one with the most host labels wins, then the one with the longest path;
of an ``allow`` and a ``block`` rule with the same host and path, ``block``. A URL without a rule gets the default verdict.

Defined results: a null URL, or one without ``://``, has an empty host and path and so no rule; a port or a
trailing dot is part of the host; an empty rule list judges every row by the default; repeated rows each get a verdict.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Above this many rules the trie is not broadcast and hosts meet the rules in joins instead (about 100 bytes a rule).
BROADCAST_RULES = 500_000
RULE_SCHEMA = "action string, host string, path string"
JUDGED = "host string, path string, rule string, verdict string"

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")
_SEGMENT = re.compile(r"[^/]*/|[^/]+")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path, both empty without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = _HOST_END.search(rest)
    if end is None:
        return rest.translate(_LOWER), ""
    host, rest = rest[: end.start()].translate(_LOWER), rest[end.start() :]
    return host, _PATH_END.split(rest, maxsplit=1)[0] if rest[0] == "/" else ""


class Node:
    """A place in the trie: the ways on by host label, by whole path segment, and the rules that end here.

    ``cut`` holds rules that end inside a segment, by the text of that part; ``verdict`` the rule that ends here.
    """

    __slots__ = ("labels", "segments", "cut", "verdict")

    def __init__(self) -> None:
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        self.cut: dict[str, tuple[str, str]] = {}
        self.verdict: tuple[str, str] | None = None


def _preferred(new: tuple[str, str], old: tuple[str, str] | None) -> tuple[str, str]:
    return old if old is not None and old[1] == "block" else new


def build_trie(rules: Iterable[tuple[str, str, str]]) -> Node:
    root = Node()
    for action, host, path in rules:
        node, name = root, (f"{host}{path}", action)
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node.labels.setdefault(label, Node())
        node = node.segments.setdefault("", Node())  # where the paths of this host begin
        for part in _SEGMENT.findall(path):
            if not part.endswith("/"):
                node.cut[part] = _preferred(name, node.cut.get(part))
                break
            node = node.segments.setdefault(part, Node())
        else:
            node.verdict = _preferred(name, node.verdict)
    return root


def _best_path(node: Node, path: str) -> tuple[str, str] | None:
    best = node.verdict
    for part in [*_SEGMENT.findall(path), ""]:
        for end in range(len(part), 0, -1) if node.cut else ():
            if (found := node.cut.get(part[:end])) is not None:
                best = found
                break
        node = node.segments.get(part) if part else None
        if node is None:
            return best
        best = node.verdict or best
    return best


def look_up(trie: Node, host: str, path: str) -> tuple[str, str] | None:
    """(rule, action) of the longest rule that fits: the deepest host with a fitting path."""
    node, best = trie, None
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        if "" in node.segments:
            best = _best_path(node.segments[""], path) or best
    return best


def judge_urls(
    pages: DataFrame,
    rules: DataFrame | Iterable[tuple[str, str, str]],
    url: str = "url",
    keep: Iterable[str] = ("page_id",),
    default: str = "allow",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """The kept columns with ``host, path, rule, verdict``; rule is host and path as written, null without one."""
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), RULE_SCHEMA)
    rules = rules.select("action", "host", "path").where("host is not null and path is not null and action in ('allow', 'block')")
    listed = rules.limit(broadcast_rules + 1).collect()
    if len(listed) > broadcast_rules:
        return _judge_by_joins(pages, rules, url, list(keep), default)
    trie = spark.sparkContext.broadcast(build_trie(tuple(r) for r in listed))

    @F.pandas_udf(JUDGED)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            out = []
            for host, path in map(split_url, urls):
                rule, verdict = look_up(trie.value, host, path) or (None, default)
                out.append((host, path, rule, verdict))
            yield pd.DataFrame(out, columns=["host", "path", "rule", "verdict"])

    own = "_judged_url"
    return pages.select(*keep, judged(F.col(url)).alias(own)).select(*keep, f"{own}.*")


def _host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def _judge_by_joins(pages: DataFrame, rules: DataFrame, url: str, keep: list[str], default: str) -> DataFrame:
    """The same for rule lists too long to broadcast: each distinct host and path meets the rules of its own suffixes."""
    host, path = _host_and_path(F.col("_u"))
    rows = pages.select(*[F.col(c).alias(f"_keep_{c}") for c in keep], F.col(url).alias("_u"))
    rows = rows.withColumns({"host": host, "path": path}).drop("_u")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rules = rules.select(
        F.concat("host", "path").alias("rule"),
        F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("_host"),
        F.col("path").alias("_path"),
        "action",
    )
    best = (
        rows.select("host", "path").distinct()
        .select("host", "path", F.explode(suffixes).alias("_host"))
        .join(rules, "_host")
        .where(F.col("path").startswith(F.col("_path")))
        .withColumn("_rank", F.struct(F.size(F.split("_host", r"\.")), F.length("_path"), F.col("action"), F.col("rule")))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "action"), "_rank").alias("_best"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.action", F.lit(default)).alias("verdict"),
    )
