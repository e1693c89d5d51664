"""Quality of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def precision_recall(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: rows, suspects, precision and recall of label 1; 0.0 where nothing was flagged or is suspect."""
    actual, flagged = F.col(label) == 1, F.col(prediction) == 1

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))

    hits = F.count_if(actual & flagged)
    return df.agg(
        F.count("*").alias("nb_lignes"),
        F.count_if(actual).alias("nb_suspects"),
        ratio(hits, F.count_if(flagged)).alias("precision_suspects"),
        ratio(hits, F.count_if(actual)).alias("rappel_suspects"),
    )


def largest_difference(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row: rows compared, largest absolute difference, rows where only one side is null."""
    return df.agg(
        F.count("*").alias("nb_lignes"),
        F.coalesce(F.max(F.abs(F.col(left) - F.col(right))), F.lit(0.0)).alias("ecart_max"),
        F.count_if(F.col(left).isNull() != F.col(right).isNull()).alias("nb_manquants"),
    )
