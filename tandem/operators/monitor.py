"""Monitoring of the pipeline from its own journals and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tandem.operators.neighbours import with_previous
from tandem.operators.summaries import count_tables


def step_durations(timings: DataFrame) -> DataFrame:
    """Per step: number of measures, shortest, mean and longest, two decimals."""
    seconds = F.col("duree_s").cast("decimal(18,6)")
    return timings.groupBy("etape").agg(
        F.count("duree_s").alias("nb_mesures"),
        F.round(F.min(seconds), 2).cast("double").alias("minimum_s"),
        F.round(F.sum(seconds) / F.count(seconds), 2).cast("double").alias("moyenne_s"),
        F.round(F.max(seconds), 2).cast("double").alias("maximum_s"),
    )


def _one_order(df: DataFrame, order_by: Sequence[str]) -> Column:
    """The order columns as one value. A time and a whole number become a decimal, which keeps an aggregate hash-based;
    other columns a struct, for which Spark sorts."""
    if len(order_by) == 1:
        return F.col(order_by[0])
    kinds = dict(df.dtypes)
    if [kinds[c].split("_")[0] for c in order_by] in (["timestamp", "bigint"], ["timestamp", "int"]):
        moment, number = order_by
        micros = F.unix_micros(F.col(moment).cast("timestamp")).cast("decimal(38,0)")
        return micros * F.lit(str(10**19)).cast("decimal(20,0)") + F.col(number).cast("decimal(20,0)")
    return F.struct(*order_by)


def slow_steps(
    timings: DataFrame,
    order_by: Sequence[str] = ("date",),
    factor: float = 2,
    minimum_s: float = 1,
    measures: int = 4,
) -> DataFrame:
    """Per step: is the last measure far above the mean of all earlier ones?

    The mean of the earlier ones comes from the total less the last one, so each step needs one aggregate
    that is combined on the map side; a step with a third of all measures is no larger task than another.
    A run without a duration is no measure. Steps with fewer than ``measures`` of them have no habit to compare
    with: not slow, no figures.
    """
    seconds = F.col("duree_s").cast("decimal(18,6)")
    latest = F.when(seconds.isNotNull(), _one_order(timings, order_by))  # a null order is never the highest
    per_step = timings.groupBy("etape").agg(
        F.count(seconds).alias("nb_mesures"),
        F.sum(seconds).alias("total"),
        F.max_by(seconds, latest).alias("last"),
    )
    enough = F.col("nb_mesures") >= measures
    mean = ((F.col("total") - F.col("last")).cast("double")) / (F.col("nb_mesures") - 1)
    last = F.col("last").cast("double")
    return per_step.select(
        "etape",
        "nb_mesures",
        F.when(enough, last).alias("derniere_s"),
        F.when(enough, mean).alias("moyenne_avant_s"),
        F.coalesce(enough & (last > factor * mean) & (last > minimum_s), F.lit(False)).alias("ralenti"),
    )


def step_names(timings: DataFrame) -> DataFrame:
    """Steps in the order of their first measure."""
    return timings.groupBy("etape").agg(F.min("date").alias("premiere")).orderBy("premiere", "etape")


def step_history(timings: DataFrame, step: str, order_by: Sequence[str] = ("date",)) -> DataFrame:
    """Durations of one step in time order."""
    return timings.filter(F.col("etape") == step).orderBy(*order_by)


def parse_status_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """``time | level | service | message`` lines as columns; a ``|`` inside the message is kept."""
    part = F.split(F.col(column), r" \| ", 4)
    return lines.select(
        part[0].try_cast("timestamp").alias("date"),
        F.get(part, F.lit(1)).alias("niveau"),
        F.get(part, F.lit(2)).alias("service"),
        F.get(part, F.lit(3)).alias("message"),
    )


def newest_lines(log: DataFrame, n: int = 40, tie_break: Sequence[str] = ()) -> DataFrame:
    return log.orderBy(F.desc("date"), *tie_break).limit(n)


def status_counts(log: DataFrame) -> DataFrame:
    """Lines per service and level."""
    return log.groupBy("service", "niveau").agg(F.count("*").alias("nb"))


def status_changes(log: DataFrame, piece: str = "hour") -> DataFrame:
    """Lines whose level is not that of the service's line before: ``service, date, avant, niveau, message``.

    The first line of a service changes from null. Lines of one moment go by message. Lines without a date or a service are none.
    A service is compared ``piece`` by piece of its time, so one that writes most lines is no larger task.
    """
    order = ["date", "message", "niveau"]
    rows = with_previous(log, "service", F.date_trunc(piece, "date"), order, ["niveau"], "precedent")
    changed = F.col("precedent").isNull() | ~F.col("precedent.niveau").eqNullSafe(F.col("niveau"))
    return rows.filter(changed).select("service", "date", F.col("precedent.niveau").alias("avant"), "niveau", "message")


def alert_periods(log: DataFrame, level: str = "ALERTE", piece: str = "hour") -> DataFrame:
    """Each stretch of time in which a service stays at ``level``: ``service, debut, fin, duree_s``.

    It ends with the service's next line of another level; one that lasts has neither end nor duration.
    """
    changes = status_changes(log, piece)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    order = ["date", "message", "niveau"]
    ended = with_previous(changes, "service", F.date_trunc(piece, "date"), order, ["date"], "suivant", back=False)
    return ended.filter(F.col("niveau") == level).select(
        "service",
        F.col("date").alias("debut"),
        F.col("suivant.date").alias("fin"),
        ((micros("suivant.date") - micros("date")) / 1_000_000).alias("duree_s"),
    )


def landed_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, ok): an empty landed table is a failed check."""
    return count_tables(tables).withColumn("ok", F.col("rows") > 0)


def failed_checks(checks: DataFrame, name: str = "table") -> DataFrame:
    """One row: number of failed checks and their names, one name per check."""
    failed = checks.filter(~F.col("ok")).select(name).distinct()
    return failed.agg(
        F.count("*").alias("nb_pannes"), F.array_join(F.sort_array(F.collect_list(name)), ", ").alias("pannes")
    )


def empty_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows in which every column is null: counts agree with the source, the content does not."""
    columns = [F.col(c) for c in df.columns if c not in ignore]
    return df.filter(F.coalesce(*(c.cast("string") for c in columns)).isNull())
