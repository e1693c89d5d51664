"""Clean each source table, map both sources to the common model and join them into one table.

Source tables are named as delivered: A_* from the first company, B_* from the second.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from tandem import catalog
from tandem.functions.amounts import monthly_from, number, yearly_from
from tandem.functions.dates import normal_date
from tandem.functions.text import clean_email, clean_text, prefixed
from tandem.operators.clean import clean_table

PREFIX = {"A": "AB-", "B": "AP-"}
day, moment = partial(normal_date, with_time=False), partial(normal_date, with_time=True)

#: Source table -> rule per column. Contracts are copied as delivered.
CLEANING = {
    "A_clients": {
        "ab_nom": clean_text, "ab_prenom": clean_text, "ab_date_naissance": day, "ab_email": clean_email,
        "ab_telephone": clean_text, "ab_adresse": clean_text, "ab_code_postal": clean_text,
        "ab_num_fiscal": clean_text, "ab_date_creation": moment, "ab_statut_client": clean_text,
    },
    "B_clients": {
        "ap_full_name": clean_text, "ap_birth_date": day, "ap_mail_address": clean_email,
        "ap_phone_number": clean_text, "ap_street_address": clean_text, "ap_zip_code": clean_text,
        "ap_created_at": moment, "ap_customer_status": clean_text,
    },
    "A_contracts": {}, "B_contracts": {},
    "A_payments": {"ab_date_paiement": day}, "B_payments": {"ap_payment_datetime": moment},
    "A_claims": {"ab_date_sinistre": moment}, "B_claims": {"ap_incident_date": day},
}

#: Source table -> duplicate key.
KEYS = {
    "A_clients": "ab_client_id", "B_clients": "ap_user_id",
    "A_contracts": "ab_policy_number", "B_contracts": "ap_contract_ref",
    "A_payments": "ab_payment_id", "B_payments": "ap_payment_ref",
    "A_claims": "ab_claim_id", "B_claims": "ap_sinistre_num",
}


def clean_source(df: DataFrame, table: str) -> DataFrame:
    return clean_table(df, CLEANING[table])


def _model(df: DataFrame, entity: str, **columns: str | Column) -> DataFrame:
    """Project to the common model; a column the source lacks is a typed null."""
    fields = []
    for field in catalog.SCHEMAS[entity].fields:
        given = columns.get(field.name)
        value = F.lit(None) if given is None else F.col(given) if isinstance(given, str) else given
        fields.append(value.cast(field.dataType).alias(field.name))
    return df.select(*fields)


def clients_a(df: DataFrame) -> DataFrame:
    return _model(
        df, "clients",
        client_id=prefixed(PREFIX["A"], F.col("ab_client_id")),
        nom_prenom=F.concat("ab_nom", F.lit("_"), "ab_prenom"),
        date_naissance="ab_date_naissance", email="ab_email", telephone="ab_telephone", adresse="ab_adresse",
        code_postal="ab_code_postal", num_fiscal="ab_num_fiscal", date_creation="ab_date_creation",
        statut_client="ab_statut_client",
    )


def clients_b(df: DataFrame) -> DataFrame:
    return _model(
        df, "clients",
        client_id=prefixed(PREFIX["B"], F.col("ap_user_id")),
        nom_prenom="ap_full_name", date_naissance="ap_birth_date", email="ap_mail_address",
        telephone="ap_phone_number", adresse="ap_street_address", code_postal="ap_zip_code",
        date_creation="ap_created_at", statut_client="ap_customer_status", loyalty_score="ap_loyalty_score",
    )


def contracts_a(df: DataFrame) -> DataFrame:
    return _model(
        df, "contrats",
        contrat_id="ab_policy_number", client_id=prefixed(PREFIX["A"], F.col("ab_client_id")),
        type_assurance="ab_type_assurance", date_debut="ab_date_debut", date_fin="ab_date_fin",
        prime_annuelle=number(F.col("ab_prime_annuelle")), statut_contrat="ab_statut_contrat",
        agence_id="ab_agence_id",
    )


def contracts_b(df: DataFrame) -> DataFrame:
    return _model(
        df, "contrats",
        contrat_id="ap_contract_ref", client_id=prefixed(PREFIX["B"], F.col("ap_user_id")),
        code_produit="ap_product_code", date_debut="ap_start_date", date_fin="ap_end_date",
        prime_mensuelle=number(F.col("ap_monthly_premium")), statut_contrat="ap_contract_state",
        code_courtier="ap_broker_code",
    )


def payments_a(df: DataFrame) -> DataFrame:
    return _model(
        df, "paiements",
        paiement_id="ab_payment_id", contrat_id="ab_policy_number", date_paiement="ab_date_paiement",
        montant=number(F.col("ab_montant")), mode_paiement="ab_mode_paiement",
    )


def payments_b(df: DataFrame) -> DataFrame:
    return _model(
        df, "paiements",
        paiement_id="ap_payment_ref", contrat_id="ap_contract_ref", date_paiement="ap_payment_datetime",
        montant=number(F.col("ap_amount_paid")), mode_paiement="ap_payment_channel",
        statut_transaction="ap_transaction_status",
    )


def claims_a(df: DataFrame) -> DataFrame:
    return _model(
        df, "sinistres",
        sinistre_id=F.col("ab_claim_id").try_cast("bigint"), contrat_id="ab_policy_number",
        date_sinistre="ab_date_sinistre", montant_estime=number(F.col("ab_montant_estime")),
        statut_sinistre="ab_statut_sinistre", description="ab_description",
    )


def claims_b(df: DataFrame) -> DataFrame:
    return _model(
        df, "sinistres",
        sinistre_id=F.col("ap_sinistre_num").try_cast("bigint"), contrat_id="ap_contract_ref",
        date_sinistre="ap_incident_date", montant_estime=number(F.col("ap_estimated_amount")),
        statut_sinistre="ap_claim_status", description="ap_claim_comment", fraud_score="ap_fraud_score",
    )


MAPPINGS = {
    "clients": (clients_a, clients_b),
    "contracts": (contracts_a, contracts_b),
    "payments": (payments_a, payments_b),
    "claims": (claims_a, claims_b),
}


def union_sources(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both mapped sources, by column name, with the source as a column: rows have no order to rely on."""
    return first.withColumn("source", F.lit("A")).unionByName(second.withColumn("source", F.lit("B")))


def fuse(table: str, raw_a: DataFrame, raw_b: DataFrame) -> DataFrame:
    """Common-model rows of one entity from both raw source tables."""
    to_a, to_b = MAPPINGS[table]
    return union_sources(
        to_a(clean_source(raw_a, f"A_{table}")), to_b(clean_source(raw_b, f"B_{table}"))
    )


def fill_premiums(contracts: DataFrame) -> DataFrame:
    """Both premiums on every contract, each from the other where it is missing."""
    yearly, monthly = F.col("prime_annuelle"), F.col("prime_mensuelle")
    filled = {"prime_annuelle": yearly_from(yearly, monthly), "prime_mensuelle": monthly_from(yearly, monthly)}
    return contracts.select(*(filled[c].alias(c) if c in filled else F.col(c) for c in contracts.columns))


def offset_claim_numbers(claims: DataFrame, first: str = "A") -> DataFrame:
    """Claim numbers unique over both sources: the second source continues after the first one's largest."""
    largest = claims.agg(F.coalesce(F.max(F.when(F.col("source") == first, F.col("sinistre_id"))), F.lit(0)))
    shifted = F.when(F.col("source") == first, F.col("sinistre_id")).otherwise(
        F.col("sinistre_id") + largest.scalar()
    )
    return claims.select(*(shifted.alias(c) if c == "sinistre_id" else F.col(c) for c in claims.columns))
