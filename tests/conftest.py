from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tandem.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    spark = session(
        "tandem-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def table(spark):
    """table("id int, nom string", (1, "a"), ...) -> DataFrame"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def rows(df) -> list[tuple]:
    """Rows as tuples in a stable order, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def column(df, name: str, by: str) -> list:
    return [r[name] for r in df.orderBy(by).collect()]
