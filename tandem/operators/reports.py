"""Row selections shown to users of the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tandem.functions.amounts import whole_percent
from tandem.functions.text import label_null


def at_least(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.filter(F.col(column) >= threshold)


def to_watch(predictions: DataFrame, threshold: float) -> DataFrame:
    """Claims from the threshold on, highest probability first."""
    return at_least(predictions, "proba_fraude", threshold).orderBy(
        F.desc("proba_fraude"), "sinistre_id", "contrat_id"
    )


def flagged_share(predictions: DataFrame, threshold: float) -> DataFrame:
    """One row: claims flagged and claims in all."""
    return predictions.agg(
        F.count_if(F.col("proba_fraude") >= threshold).alias("nb_signales"), F.count("*").alias("nb_total")
    )


def with_status(df: DataFrame, column: str, status: str, empty_label: str) -> DataFrame:
    """Rows of one status; the label stands for null."""
    return df.filter(label_null(F.col(column), empty_label) == status)


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """Preview: Spark keeps n rows per task and merges those, no full sort."""
    return df.orderBy(*order_by).limit(n)


def only_columns(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Allow-list projection: a column that is added to the table later does not leak."""
    return df.select(*(c for c in df.columns if c in set(allowed)))


def as_percent(predictions: DataFrame, column: str = "proba_fraude") -> DataFrame:
    """Whole percent for spreadsheets, with the unit in the column name."""
    return predictions.select(
        *(
            whole_percent(F.col(c)).alias(f"{c} (%)") if c == column else F.col(c)
            for c in predictions.columns
        )
    )
