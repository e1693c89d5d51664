"""Duplicate removal with a stated survivor.

The order that picks the survivor covers whole rows, so the result does not depend on partitioning, and rows
that tie are identical. No task ever receives all rows of one key, however many rows share it:

- ``keep_first`` filters on a row number, which Spark turns into a limit per key on the map side, before the
  shuffle.
- ``mark_repeats`` shuffles once, by key and salt. Only keys that hold a stated share of all rows have more than
  one salt; the first row of such a key is found beforehand, by an aggregate that is combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tandem.operators.joins import hot_keys

_RANK, _KEY, _HOT, _SALT, _BEST = "_rank", "_key", "_hot", "_salt", "_best"
#: Parts into which the rows of a hot key are dealt.
SPREAD = 256
REPEAT = "doublon"


def folded(df: DataFrame, key: str, ignore_case: bool) -> Column:
    """The key, in lower case if text is to be compared without case."""
    return F.lower(F.col(key)) if ignore_case and dict(df.dtypes)[key] == "string" else F.col(key)


def _keys(df: DataFrame, names: Sequence[str], ignore_case: bool) -> list[Column]:
    return [folded(df, n, ignore_case) for n in names]


def _whole_row(df: DataFrame, order_by: Sequence[str | Column]) -> list[str | Column]:
    named = {c for c in order_by if isinstance(c, str)}
    return [*order_by, *(c for c in df.columns if c not in named)]


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    ignore_case: bool = False,
) -> DataFrame:
    """One row per key: the first in ``order_by``, ties broken by the other columns. Null keys are equal."""
    ranked = Window.partitionBy(*_keys(df, keys, ignore_case)).orderBy(*_whole_row(df, order_by))
    return df.withColumn(_RANK, F.row_number().over(ranked)).filter(F.col(_RANK) == 1).drop(_RANK)


def mark_repeats(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    ignore_case: bool = True,
    nulls_differ: bool = False,
    share: float = 0.001,
) -> DataFrame:
    """``df`` plus the column ``doublon``: false for the first row of each key, true for every later one.

    With ``nulls_differ`` a row that lacks a key repeats nothing, and is not shuffled at all. The salt is a hash of the
    whole row, so marks survive a lost executor and rows that are the same meet.
    """
    order = _whole_row(df, order_by)
    if nulls_differ:
        some = reduce(and_, (F.col(k).isNotNull() for k in keys))
        alone = df.filter(~some).withColumn(REPEAT, F.lit(False))
        return mark_repeats(df.filter(some), keys, order_by, ignore_case).union(alone)

    rows = df.withColumn(_KEY, F.xxhash64(*_keys(df, keys, ignore_case)))
    hot = F.broadcast(hot_keys(rows.select(_KEY), _KEY, share, 1).withColumn(_HOT, F.lit(True)))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)).cast("int")
    dealt = rows.join(hot, _KEY, "left").withColumn(_SALT, F.when(F.col(_HOT), spread).otherwise(0))
    # The first row of each hot key, by the rows of hot keys alone: the order columns, which identify it, and its salt.
    names = [f"_o{i}" for i in range(len(order))]
    ordered = F.struct(*(o.alias(n) if isinstance(o, Column) else F.col(o).alias(n) for o, n in zip(order, names)), F.col(_SALT).alias(_SALT))
    key = [k.alias(f"_k{i}") for i, k in enumerate(_keys(df, keys, ignore_case))]
    best = rows.join(hot, _KEY).withColumn(_SALT, spread).groupBy(*key).agg(F.min(ordered)[_SALT].alias(_BEST))
    best = F.broadcast(best)  # one row for each hot key; for each key that shares its hash, at worst

    within = Window.partitionBy(*_keys(df, keys, ignore_case), _SALT).orderBy(*order)
    ranked = dealt.withColumn(_RANK, F.row_number().over(within))
    same = reduce(and_, (k.eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(_keys(df, keys, ignore_case))))
    marked = ranked.join(best, same, "left")
    survives = (F.col(_RANK) == 1) & F.coalesce(F.col(_SALT) == F.col(_BEST), F.lit(True))
    return marked.select(*df.columns, (~survives).alias(REPEAT))


def split_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = (), ignore_case: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(first row per key, every later row). Together they hold exactly the rows of ``df``.

    To write both, ``mark_repeats`` and one write partitioned by the mark reads the input only once.
    """
    marked = mark_repeats(df, keys, order_by, ignore_case)
    return keep_first(df, keys, order_by, ignore_case), marked.filter(F.col(REPEAT)).drop(REPEAT)


def mark_merged(
    df: DataFrame, on: str, priority: Sequence[str], then_by: Sequence[str] = (), source: str = "source"
) -> DataFrame:
    """Mark the duplicates between sources: rows that agree in ``on``, without regard to case.

    The source named first in ``priority`` survives; sources it doesn't name come after all that it does. Rows
    without a value in ``on`` all survive, since nothing says whom they stand for.
    """
    place = F.array_position(F.array(*(F.lit(p) for p in priority)), F.col(source))
    rank = F.when(place > 0, place).otherwise(len(priority) + 1)
    return mark_repeats(df, [on], [rank, *then_by], nulls_differ=True)


def merge_sources(
    df: DataFrame, on: str, priority: Sequence[str], then_by: Sequence[str] = (), source: str = "source"
) -> tuple[DataFrame, DataFrame]:
    """Duplicates between sources: (survivors, rows dropped)."""
    marked = mark_merged(df, on, priority, then_by, source)
    return marked.filter(~F.col(REPEAT)).drop(REPEAT), marked.filter(F.col(REPEAT)).drop(REPEAT)
