"""Training set preparation: labels, class weights and stratified folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

#: Hash buckets per label. Running counts of buckets are the only table broadcast: labels x 4096 rows.
_HEX_DIGITS = 3


def class_weights(df: DataFrame, label: str = "label", weight: str = "poids") -> DataFrame:
    """Negatives per positive as the weight of label 1, and 1.0 for label 0."""
    positives = F.count_if(F.col(label) == 1)
    ratio = df.agg((F.count("*") - positives) / F.nullif(positives, F.lit(0))).scalar()
    return df.withColumn(weight, F.when(F.col(label) == 1, ratio).otherwise(1.0))


def stratified_folds(
    df: DataFrame, ids: Sequence[str], label: str = "label", folds: int = 5, seed: int = 42, fold: str = "pli"
) -> DataFrame:
    """Fold number 0 .. folds-1, the rows of each label dealt evenly in a random but repeatable order.

    The order is that of ``md5(ids, seed)``, so folds do not depend on partitioning; ``ids`` must tell rows
    apart. Rows are numbered inside hash buckets, thousands of small tasks per label, and the bucket counts
    before each give the offset: the numbers equal those of one long row count per label. Rows without a label
    are dealt out like those of a label of their own.
    """
    digest = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in ids), F.lit(str(seed))))
    rows = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, _HEX_DIGITS))

    sizes = rows.groupBy(label, "_bucket").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(label).alias("_of"), F.col("_bucket").alias("_in"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(label, "_bucket").orderBy("_digest", *ids)
    return (
        rows.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), F.col(label).eqNullSafe(F.col("_of")) & (F.col("_bucket") == F.col("_in")))
        .withColumn(fold, ((F.col("_offset") + F.col("_place")) % folds).cast("int"))
        .drop("_digest", "_bucket", "_place", "_of", "_in", "_offset")
    )


def fold_sizes(df: DataFrame, label: str = "label", fold: str = "pli") -> DataFrame:
    return df.groupBy(label, fold).agg(F.count("*").alias("nb"))
