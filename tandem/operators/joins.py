"""Left joins that stay balanced when one key holds a large part of the left side."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, functions as F

_HOT, _SALT, _ROWS = "_hot", "_salt", "_rows"
#: Fewer than the 128 groups up to which Spark keeps such aggregates in a hash map.
_BUCKETS = 100


def hot_keys(keys: DataFrame, on: str, share: float, at_least: int) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: about ``1 / share`` of them at most.

    One pass with frequency sketches, one per hash bucket of the keys: the keys themselves are not shuffled,
    each task sends sketches of fixed size, and as many tasks as buckets merge them. Within its bucket such a
    key stands out a hundredfold, so a small sketch is enough. A key missed or listed for nothing would
    change the balance of the join, not its result.
    """
    tracked = max(64, ceil(10 / (share * _BUCKETS)))
    per_bucket = (
        keys.filter(F.col(on).isNotNull())
        .groupBy(F.pmod(F.xxhash64(on), F.lit(_BUCKETS)).alias("bucket"))
        .agg(F.expr(f"approx_top_k(`{on}`, {tracked // 2}, {tracked})").alias("top"), F.count("*").alias(_ROWS))
    )
    # At most buckets x tracked / 2 keys, whatever the size of the table.
    top = per_bucket.agg(F.flatten(F.collect_list("top")).alias("top"), F.sum(_ROWS).alias(_ROWS))
    enough = F.greatest(F.lit(at_least), F.col(_ROWS) * share)
    return top.select(F.explode("top").alias("top"), enough.alias("enough")).filter(
        F.col("top.count") >= F.col("enough")
    ).select(F.col("top.item").alias(on))


def attach(
    left: DataFrame,
    rights: Sequence[DataFrame],
    on: str,
    spread_by: Sequence[str],
    keys_from: DataFrame | None = None,
    share: float = 0.001,
    at_least: int = 1_000_000,
    spread: int = 256,
) -> DataFrame:
    """``left`` left-joined to each of ``rights`` on one column, all with a single shuffle of ``left``.

    Left rows of a hot key are spread over ``spread`` buckets by a hash of ``spread_by``, and only the right
    rows of hot keys are repeated, once per bucket. Left rows without a key are spread too: they match
    nothing, but would otherwise meet in one task. The list of hot keys is broadcast; its size is bounded
    by ``share`` whatever the size of the tables. ``keys_from`` may give a cheaper table with the same
    keys to count, such as the input of a long plan.

    Every other choice between broadcast and sort-merge is left to Spark, which knows the sizes.
    """
    hot = hot_keys(left if keys_from is None else keys_from, on, share, at_least)
    hot = F.broadcast(hot.withColumn(_HOT, F.lit(True)))
    is_hot = F.coalesce(F.col(_HOT), F.lit(False))

    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(spread)).cast("int")
    out = left.join(hot, on, "left").withColumn(
        _SALT, F.when(is_hot | F.col(on).isNull(), bucket).otherwise(0)
    ).drop(_HOT)
    every_bucket = F.sequence(F.lit(0), F.lit(spread - 1))
    for right in rights:
        copies = right.filter(F.col(on).isNotNull()).join(hot, on, "left").withColumn(
            _SALT, F.explode(F.when(is_hot, every_bucket).otherwise(F.array(F.lit(0))))
        ).drop(_HOT)
        out = out.join(copies, [on, _SALT], "left")
    return out.drop(_SALT)
