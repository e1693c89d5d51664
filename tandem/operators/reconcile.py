"""Row-count control at every hop."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tandem.operators.dedup import folded
from tandem.operators.summaries import count_tables


def extraction_control(sources: Mapping[str, DataFrame], extracted: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in the source and in the extraction, the gap, and OK or KO."""
    before = count_tables(sources).withColumnRenamed("rows", "nb_lignes_source")
    after = count_tables(extracted).withColumnRenamed("rows", "nb_lignes_extraites")
    gap = F.col("nb_lignes_extraites") - F.col("nb_lignes_source")
    return before.join(after, "table", "full").fillna(0).select(
        "table",
        "nb_lignes_source",
        "nb_lignes_extraites",
        gap.alias("ecart"),
        F.when(gap == 0, "OK").otherwise("KO").alias("statut"),
    )


def counted_control(name: str, entered: int, extracted: DataFrame) -> DataFrame:
    """The same for one table, with the rows counted as they entered."""
    gap = F.col("rows") - entered
    return count_tables({name: extracted}).select(
        "table",
        F.lit(entered).cast("long").alias("nb_lignes_source"),
        F.col("rows").alias("nb_lignes_extraites"),
        gap.alias("ecart"),
        F.when(gap == 0, "OK").otherwise("KO").alias("statut"),
    )


def sent_control(topic: str, attempted: int, sent: int) -> dict[str, object]:
    """A row of the publishing journal."""
    return {"topic": topic, "tentes": attempted, "reussis": sent, "echoues": attempted - sent}


def fusion_control(
    first: Mapping[str, DataFrame], second: Mapping[str, DataFrame], fused: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows of both sources, rows after the fusion, and duplicates merged away."""
    counts = count_tables(first).withColumnRenamed("rows", "nb_lignes_a")
    counts = counts.join(count_tables(second).withColumnRenamed("rows", "nb_lignes_b"), "table")
    counts = counts.join(count_tables(fused).withColumnRenamed("rows", "nb_lignes_finales"), "table")
    merged = F.col("nb_lignes_a") + F.col("nb_lignes_b") - F.col("nb_lignes_finales")
    return counts.select(
        F.col("table").alias("table_cible"), "nb_lignes_a", "nb_lignes_b", "nb_lignes_finales",
        merged.alias("nb_doublons_fusionnes"),
    )


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """Unique and duplicate rows of a table, from one count per key; text keys compared without case."""
    per_key = df.groupBy(folded(df, key, ignore_case=True).alias(key)).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.count("*").alias("nb_uniques"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("nb_doublons")
    )


def publish_control(attempted: Mapping[str, int], landed: Mapping[str, DataFrame]) -> DataFrame:
    """Messages sent (observed while writing), landed and lost, per topic."""
    spark = next(iter(landed.values())).sparkSession
    sent = spark.createDataFrame(list(attempted.items()), "topic string, tentes long")
    counts = count_tables(landed).withColumnRenamed("table", "topic").withColumnRenamed("rows", "reussis")
    return sent.join(counts, "topic", "left").fillna(0, ["reussis"]).withColumn(
        "echoues", F.col("tentes") - F.col("reussis")
    )


def journal_row(control: DataFrame) -> DataFrame:
    """Control rows with the time of the run, ready to append."""
    return control.select(F.current_timestamp().alias("date_execution"), "*")
