"""Prepared tables: cleaned, harmonised, one row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tandem import catalog
from tandem.functions.amounts import product_family, yearly_premium
from tandem.functions.dates import to_time
from tandem.functions.vocab import translate_statuses
from tandem.operators.clean import blank_to_null
from tandem.operators.dedup import keep_first
from tandem.operators.summaries import claims_per_contract, paid_per_contract


def tidy(df: DataFrame) -> DataFrame:
    """Blank text to null, status words harmonised."""
    return translate_statuses(blank_to_null(df))


def tidy_entity(df: DataFrame, entity: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Tidy a landed table, or some of its columns, and keep one row per duplicate key."""
    order = [c for c in catalog.SURVIVOR_ORDER[entity] if c in df.columns]
    return keep_first(tidy(df), keys or catalog.DEDUP_KEYS[entity], order)


def prepare_clients(clients: DataFrame) -> DataFrame:
    return tidy_entity(clients, "clients", ["client_id"]).select(
        "client_id", "nom_prenom", "date_naissance", "email", "telephone", "statut_client", "date_creation",
        "loyalty_score",
    )


def complete_contracts(contracts: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    """Yearly premium and insurance type on every contract, whichever way its source states them."""
    filled = {
        "prime_annuelle": yearly_premium(F.col("prime_annuelle"), F.col("prime_mensuelle"), zero_is_missing),
        "type_assurance": product_family(F.col("type_assurance"), F.col("code_produit")),
    }
    return contracts.select(*(filled[c].alias(c) if c in filled else F.col(c) for c in contracts.columns))


def prepare_contracts(contracts: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    start, end = to_time(F.col("date_debut")), to_time(F.col("date_fin"))
    return tidy_entity(contracts, "contrats", ["contrat_id"]).select(
        "contrat_id",
        "client_id",
        product_family(F.col("type_assurance"), F.col("code_produit")).alias("famille_produit"),
        yearly_premium(F.col("prime_annuelle"), F.col("prime_mensuelle"), zero_is_missing).alias(
            "prime_annuelle_eq"
        ),
        "statut_contrat",
        start.alias("date_debut"),
        end.alias("date_fin"),
        F.datediff(end, start).alias("duree_contrat_jours"),
    )


def prepare_payments(payments: DataFrame) -> DataFrame:
    """Payments per contract: number, total, failures."""
    return paid_per_contract(tidy_entity(payments, "paiements", ["paiement_id"]))


def prepare_claims(claims: DataFrame) -> DataFrame:
    """Claims per contract: number, total, rejections."""
    return claims_per_contract(tidy_entity(claims, "sinistres", ["sinistre_id"]))
