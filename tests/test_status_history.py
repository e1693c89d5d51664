"""Status changes and alert periods against a plain walk over each service's lines."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tandem.operators import monitor
from tandem.operators.neighbours import with_previous

SCHEMA = "date timestamp_ntz, niveau string, service string, message string"


def lines(seed: int, n: int, hot: float = 0.5) -> list[tuple]:
    rng = random.Random(seed)
    start = dt.datetime(2024, 3, 1, 22, 0)
    out = []
    for i in range(n):
        service = "Spark" if rng.random() < hot else rng.choice(["Kafka", "Hadoop", None])
        moment = None if rng.random() < 0.03 else start + dt.timedelta(minutes=rng.randrange(0, 400))
        out.append((moment, rng.choice(["OK", "OK", "ALERTE", None]), service, f"m{i % 50}"))
    return out


def walked(log: list[tuple]) -> tuple[list, list]:
    changes, periods = [], []
    known = [x for x in log if x[0] is not None and x[2] is not None]
    for service in {x[2] for x in known}:
        own = sorted((x for x in known if x[2] == service), key=lambda x: (x[0], x[3], x[1] is not None, x[1] or ""))
        found = [
            (service, x[0], own[i - 1][1] if i else None, x[1], x[3])
            for i, x in enumerate(own) if not i or own[i - 1][1] != x[1]
        ]
        changes += found
        for i, (_, moment, _, level, _) in enumerate(found):
            if level == "ALERTE":
                end = found[i + 1][1] if i + 1 < len(found) else None
                periods.append((service, moment, end, (end - moment).total_seconds() if end else None))
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted(changes, key=key), sorted(periods, key=key)


@pytest.mark.parametrize("piece", ["hour", "minute", "year"])
def test_changes_and_periods(spark, piece):
    log = lines(3, 600)
    df = spark.createDataFrame(log, SCHEMA)
    changes, periods = walked(log)
    assert rows(monitor.status_changes(df, piece)) == changes
    assert rows(monitor.alert_periods(df, piece=piece)) == periods


def test_empty_and_single_lines(spark, table):
    empty = spark.createDataFrame([], SCHEMA)
    assert monitor.status_changes(empty).count() == monitor.alert_periods(empty).count() == 0
    one = spark.createDataFrame([(dt.datetime(2024, 1, 1), "ALERTE", "Spark", "seul")], SCHEMA)
    assert rows(monitor.alert_periods(one)) == [("Spark", dt.datetime(2024, 1, 1), None, None)]


def test_a_group_is_dealt_out_by_its_pieces(spark):
    """A window over whole groups would put the one group in one task; here every piece may lie in another."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.col("id").alias("at"), (F.col("id") % 7).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = with_previous(df, "g", F.floor(F.col("at") / 100), ["at"], ["at", "v"], "before")
        sizes = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 6_000
    assert found.filter("before IS NULL").count() == 1
    assert found.filter("before.at <> at - 1 OR before.v <> (at - 1) % 7").count() == 0
