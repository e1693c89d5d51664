"""Counts and totals per contract, and the counts shown in reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tandem import catalog
from tandem.functions.amounts import money, total_money
from tandem.functions.text import label_null


def _count_of(column: str, word: str) -> Column:
    return F.count_if(F.col(column) == word)


def payments_per_contract(payments: DataFrame) -> DataFrame:
    """Number of payments and of failed ones."""
    return payments.groupBy("contrat_id").agg(
        F.count("*").alias("nb_paiements"),
        _count_of("statut_transaction", catalog.FAILED_PAYMENT).alias("nb_paiements_echoues"),
    )


def paid_per_contract(payments: DataFrame) -> DataFrame:
    """Number of payments, total paid and number of failed ones."""
    return payments.groupBy("contrat_id").agg(
        F.count("*").alias("nb_paiements"),
        total_money(F.col("montant")).alias("total_paye"),
        _count_of("statut_transaction", catalog.FAILED_PAYMENT).alias("nb_paiements_echoues"),
    )


def claims_per_contract(claims: DataFrame) -> DataFrame:
    """Number of claims, estimated total and number of rejected ones."""
    return claims.groupBy("contrat_id").agg(
        F.count("*").alias("nb_sinistres"),
        total_money(F.col("montant_estime")).alias("total_sinistres"),
        _count_of("statut_sinistre", catalog.REJECTED_CLAIM).alias("nb_sinistres_rejetes"),
    )


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows), one row per table, counted in one job."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def count_by(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Rows per group; null groups carry the label given for their column."""
    return df.groupBy(*(label_null(F.col(c), label).alias(c) for c, label in labels.items())).agg(
        F.count("*").alias("nb")
    )


def most_frequent_first(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counts.orderBy(F.desc("nb"), *keys)


def total_amount(df: DataFrame, column: str, alias: str) -> DataFrame:
    """One row: the exact total, 0 for an empty table, unreadable amounts left out."""
    return df.agg(F.coalesce(F.sum(money(F.col(column))), F.lit(0)).cast("double").alias(alias))
