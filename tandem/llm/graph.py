"""Connected components of a table of links, by alternating stars; nothing is gathered in one place."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.session import store


def _stars(links: DataFrame) -> DataFrame:
    """One round: hang larger neighbours on the smallest, then smaller neighbours on the smallest of them."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return small.select("e.*").where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node that has a link; root is the smallest node that can be reached.

    ``links`` has long columns ``u`` and ``v``, in either direction. Each round is written to the shared folder; the
    number of rounds grows with the logarithm of the longest path.
    """
    now = store(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    state = _state(now)
    while state[0]:
        now = store(_stars(now), name)
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))


#: Links that one task unites at a time; 16 bytes each.
LINKS_OF_A_TASK = 500_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node of the links of one task that is not the smallest of its component there, with that smallest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (above := parent.get(top, top)) != top:
            top = above
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pd.DataFrame({"u": nodes, "v": [root(n) for n in nodes]}, dtype="int64")


def united(links: DataFrame, name: str = "united", most: int = LINKS_OF_A_TASK) -> DataFrame:
    """The same as ``components`` with fewer jobs: tasks first unite the links they hold, ``most`` at a time.

    That leaves a link for each node and task at most; where one task held them all, nothing is left to do.
    """
    links = store(links.where("u <> v").select("u", "v"), name)
    tasks = -(-links.count() // most)
    if not tasks:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    kept = links.coalesce(1) if tasks == 1 else links.repartition(tasks)
    forest = store(kept.mapInPandas(_forest, "u long, v long"), name)
    if tasks > 1:
        return components(forest, name)
    return forest.select(F.col("u").alias("node"), F.col("v").alias("root")).union(forest.select("v", "v").distinct())
