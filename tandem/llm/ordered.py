"""Rows dealt to partitions by ranges of a key, so that the order of the key runs through the partitions.

Spark's own range exchange samples by running its input twice and leaves its bounds unknown. Here the bounds are
approximate percentiles of the key column alone, so an expensive input runs once and a row's neighbour can be
told to lie in the next bucket. Bounds and first keys are one value a bucket, whatever the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.session import shared_folder

BUCKET, LENT = "_bucket", "_lent"


def partitions(df: DataFrame) -> int:
    """As many as the session deals out."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """The rows sorted by the keys (nulls first) through all partitions, checkpointed: every job that reads them finds the
    same rows in the partition of the same number, so what one partition says can be handed to the next."""
    context, folder = df.sparkSession.sparkContext, shared_folder(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.repartitionByRange(partitions(df), *keys).sortWithinPartitions(*keys).checkpoint()


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the session deals out partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def key_bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """Upper bounds (inclusive) of all buckets but the last, ascending; fewer where the key has few values."""
    if buckets < 2:
        return []
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    found = df.agg(F.percentile_approx(F.col(key), shares, 10 * buckets + 1000)).first()[0]
    return sorted(set(found or []))


def bucket_of(key: str, bounds: list[int]) -> Column:
    """0 for a null key, which comes before all others."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(key)))


def deal(df: DataFrame, key: str, bounds: list[int], *ties: str) -> DataFrame:
    """One bucket a partition, sorted by the key (nulls first), then by ``ties``; adds the column ``_bucket``."""
    dealt = df.withColumn(BUCKET, bucket_of(key, bounds)).repartitionById(len(bounds) + 1, F.col(BUCKET))
    return dealt.sortWithinPartitions(key, *ties)


def deal_with_next(df: DataFrame, key: str, bounds: list[int], *ties: str) -> DataFrame:
    """As ``deal``, and each bucket ends with the rows that follow its last one, marked ``_lent``.

    These are the rows with the first key of the next bucket that has any; after the last bucket comes the first.
    """
    rows = df.withColumn(BUCKET, bucket_of(key, bounds))
    found = sorted(rows.groupBy(BUCKET).agg(F.min(F.struct(key))[key].alias("first")).collect())
    firsts, before = [None] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for i, (b, first) in enumerate(found):
        firsts[b], before[b] = first, found[i - 1][BUCKET]
    is_first = F.col(key).eqNullSafe(F.get(F.array(*[F.lit(v).cast("long") for v in firsts]), F.col(BUCKET)))
    lent = F.struct(F.get(F.array(*map(F.lit, before)), F.col(BUCKET)).alias("b"), F.lit(True).alias("lent"))
    own = F.struct(F.col(BUCKET).alias("b"), F.lit(False).alias("lent"))
    to = F.explode(F.when(is_first, F.array(own, lent)).otherwise(F.array(own)))
    dealt = rows.withColumn("_to", to).withColumns({BUCKET: F.col("_to.b"), LENT: F.col("_to.lent")}).drop("_to")
    return dealt.repartitionById(len(bounds) + 1, F.col(BUCKET)).sortWithinPartitions(LENT, key, *ties)
