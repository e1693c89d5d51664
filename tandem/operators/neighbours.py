"""The row before each row of a group, without putting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_PART, _OWN, _EDGE = "_part", "_own", "_edge"


def with_previous(
    df: DataFrame, group: str, part: Column, order_by: Sequence[str], columns: Sequence[str], into: str, back: bool = True
) -> DataFrame:
    """Add a struct ``into`` with ``columns`` of the row before (``back``) or after each row of its group; null for the first.

    ``part`` cuts a group into consecutive pieces of its order, such as the hour of a time, and is part of that order: a later
    row never has a smaller part. Rows are compared inside a piece; of each piece one row is handed to the next one, so a group
    that holds a third of all rows is many tasks. Rows with a null group or part are left out.
    """
    order = [F.col(c).asc_nulls_first() if back else F.col(c).desc_nulls_last() for c in order_by]
    rows = df.withColumn(_PART, part).filter(F.col(group).isNotNull() & F.col(_PART).isNotNull())
    taken = F.struct(*columns)
    inside = Window.partitionBy(group, _PART).orderBy(*order)
    rows = rows.withColumns({_OWN: F.lag(taken).over(inside), "_first": F.row_number().over(inside) == 1})
    key = F.struct(*order_by)
    pick = F.max_by if back else F.min_by
    edges = rows.groupBy(group, _PART).agg(pick(taken, key).alias(_EDGE))
    between = Window.partitionBy(group).orderBy(F.col(_PART).asc() if back else F.col(_PART).desc())
    handed = edges.select(group, _PART, F.lag(_EDGE).over(between).alias(_EDGE))
    joined = rows.join(handed, [group, _PART], "left")
    value = F.when(F.col("_first"), F.col(_EDGE)).otherwise(F.col(_OWN))
    return joined.withColumn(into, value).select(*df.columns, into)
