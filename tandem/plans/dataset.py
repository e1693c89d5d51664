"""The claim dataset: one row per claim and contract row, with contract and payment features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tandem import catalog
from tandem.functions.amounts import suspect_label
from tandem.functions.dates import days_between
from tandem.operators.clean import zero_when_null
from tandem.operators.joins import attach
from tandem.operators.summaries import payments_per_contract
from tandem.plans.prepare import complete_contracts, tidy_entity

_CLAIM_INPUT = [
    "sinistre_id", "contrat_id", "date_sinistre", "montant_estime", "statut_sinistre", "fraud_score",
]
_CONTRACT_INPUT = [
    "contrat_id", "client_id", "type_assurance", "code_produit", "date_debut", "prime_annuelle",
    "prime_mensuelle",
]
_PAYMENT_INPUT = ["paiement_id", "contrat_id", "statut_transaction"]


def link(
    claims: DataFrame,
    contracts: DataFrame,
    payment_summary: DataFrame,
    keys_from: DataFrame | None = None,
    **spread,
) -> DataFrame:
    """Every claim with its contract columns and payment counts.

    A contract number with several clients gives a claim one row per client.
    """
    return attach(
        claims, [contracts, payment_summary], "contrat_id", ["sinistre_id", "contrat_id"], keys_from, **spread
    )


def add_features(linked: DataFrame) -> DataFrame:
    """Days from contract start to claim; missing counts and amounts become 0."""
    days = days_between(F.col("date_debut"), F.col("date_sinistre"))
    return zero_when_null(
        linked.withColumn("jours_avant_sinistre", days),
        ["nb_paiements", "nb_paiements_echoues", "montant_estime"],
    )


def discard_reason() -> Column:
    """Why a row is not usable: null for a coherent one."""
    return (
        F.when(~F.coalesce(F.col("montant_estime") > 0, F.lit(False)), "montant_estime")
        .when(F.col("jours_avant_sinistre").isNull(), "date")
        .when(F.col("jours_avant_sinistre") < 0, "jours_avant_sinistre")
    )


def coherent_rows(df: DataFrame) -> DataFrame:
    """Amount above 0 and a claim date on or after the contract start."""
    return df.filter((F.col("montant_estime") > 0) & (F.col("jours_avant_sinistre") >= 0))


def discarded_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("motif", discard_reason()).filter(F.col("motif").isNotNull())


def payment_summary(payments: DataFrame) -> DataFrame:
    """Payment counts per contract; only the three columns they depend on are read."""
    return payments_per_contract(tidy_entity(payments.select(*_PAYMENT_INPUT), "paiements"))


def claim_features(claims: DataFrame, contracts: DataFrame, payments: DataFrame, **spread) -> DataFrame:
    """All linked claims with features, coherent or not."""
    linked = link(
        tidy_entity(claims.select(*_CLAIM_INPUT), "sinistres"),
        complete_contracts(tidy_entity(contracts.select(*_CONTRACT_INPUT), "contrats")),
        payment_summary(payments),
        keys_from=claims,
        **spread,
    )
    return add_features(linked)


def claim_dataset(claims: DataFrame, contracts: DataFrame, payments: DataFrame, **spread) -> DataFrame:
    """Coherent claims with the ten dataset columns."""
    return coherent_rows(claim_features(claims, contracts, payments, **spread)).select(*catalog.DATASET_COLUMNS)


def training_rows(dataset: DataFrame, threshold: float = catalog.SUSPECT_SCORE) -> DataFrame:
    """Claims with a known score, labelled."""
    return dataset.filter(F.col("fraud_score").isNotNull()).withColumn(
        "est_suspect", suspect_label(F.col("fraud_score"), threshold)
    )


def rows_to_predict(dataset: DataFrame) -> DataFrame:
    return dataset.filter(F.col("fraud_score").isNull())


def label_counts(training: DataFrame) -> DataFrame:
    return training.groupBy("est_suspect").agg(F.count("*").alias("nb"))


def write_dataset(dataset: DataFrame, path: str) -> None:
    """Both sets in one pass: a folder per ``note_connue`` (1 or 0), so readers of one skip the other."""
    known = F.col("fraud_score").isNotNull()
    labelled = dataset.withColumn("est_suspect", F.when(known, suspect_label(F.col("fraud_score"))))
    labelled.withColumn("note_connue", known.cast("int")).write.mode("overwrite").partitionBy("note_connue").parquet(path)
