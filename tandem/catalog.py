"""Schemas, vocabularies, topics and defaults that fix the results.

The names and words below are data formats shared with the producers and readers of the tables, so they
are stated as they appear there.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Common model -----------------------------------------------------------------------------------
CLIENT_COLUMNS = [
    "client_id", "nom_prenom", "date_naissance", "email", "telephone", "adresse", "code_postal",
    "num_fiscal", "date_creation", "statut_client", "loyalty_score",
]
CONTRACT_COLUMNS = [
    "contrat_id", "client_id", "type_assurance", "code_produit", "date_debut", "date_fin",
    "prime_annuelle", "prime_mensuelle", "statut_contrat", "agence_id", "code_courtier",
]
PAYMENT_COLUMNS = [
    "paiement_id", "contrat_id", "date_paiement", "montant", "mode_paiement", "statut_transaction",
]
CLAIM_COLUMNS = [
    "sinistre_id", "contrat_id", "date_sinistre", "montant_estime", "statut_sinistre", "description",
    "fraud_score",
]


def _schema(columns: list[str], **typed: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, typed.get(c, T.StringType())) for c in columns])


#: Entity -> schema of its messages and landed table. Amounts are doubles: a single-precision float would
#: change cents when widened later.
SCHEMAS = {
    "clients": _schema(CLIENT_COLUMNS),
    "contrats": _schema(CONTRACT_COLUMNS, prime_annuelle=T.DoubleType(), prime_mensuelle=T.DoubleType()),
    "paiements": _schema(PAYMENT_COLUMNS, montant=T.DoubleType()),
    "sinistres": _schema(CLAIM_COLUMNS, sinistre_id=T.LongType(), montant_estime=T.DoubleType()),
}

#: Source table -> columns of the delivered files that are no text. All others are. Ids that carry a prefix or a line number
#: are text.
DELIVERED_TYPES: dict[str, dict[str, T.DataType]] = {
    "A_clients": {"ab_client_id": T.LongType(), "ab_date_naissance": T.DateType(), "ab_date_creation": T.TimestampNTZType()},
    "A_contracts": {
        "ab_client_id": T.LongType(), "ab_date_debut": T.DateType(), "ab_date_fin": T.DateType(),
        "ab_prime_annuelle": T.DoubleType(), "ab_agence_id": T.LongType(),
    },
    "A_payments": {"ab_date_paiement": T.DateType(), "ab_montant": T.DoubleType()},
    "A_claims": {"ab_claim_id": T.LongType(), "ab_date_sinistre": T.DateType(), "ab_montant_estime": T.DoubleType()},
    "B_clients": {
        "ap_user_id": T.LongType(), "ap_birth_date": T.DateType(), "ap_created_at": T.TimestampNTZType(),
        "ap_loyalty_score": T.LongType(),
    },
    "B_contracts": {
        "ap_user_id": T.LongType(), "ap_start_date": T.DateType(), "ap_end_date": T.TimestampNTZType(),
        "ap_monthly_premium": T.DoubleType(),
    },
    "B_payments": {"ap_payment_datetime": T.TimestampNTZType(), "ap_amount_paid": T.DoubleType()},
    "B_claims": {"ap_sinistre_num": T.LongType(), "ap_incident_date": T.TimestampNTZType(), "ap_estimated_amount": T.DoubleType()},
}


def delivered_schema(table: str, columns: list[str]) -> T.StructType:
    """The schema of a source table's delivered file, its columns in the order given."""
    return _schema(columns, **DELIVERED_TYPES[table])


#: Entity -> column used as the message key.
MESSAGE_KEYS = {
    "clients": "client_id", "contrats": "contrat_id", "paiements": "paiement_id", "sinistres": "sinistre_id",
}

#: Entity -> duplicate key. Ids are reused between sources, so the second column belongs to the key.
DEDUP_KEYS = {
    "clients": ["client_id", "email"],
    "contrats": ["contrat_id", "client_id"],
    "paiements": ["paiement_id", "contrat_id"],
    "sinistres": ["sinistre_id", "contrat_id"],
}

#: Which of several rows with one key survives: the first by these columns. The columns the claim dataset
#: reads come first, so it finds the same survivor without reading the others.
SURVIVOR_ORDER = {
    "clients": ["date_creation", "nom_prenom", "date_naissance"],
    "contrats": ["type_assurance", "code_produit", "date_debut", "prime_annuelle", "prime_mensuelle"],
    "paiements": ["statut_transaction", "date_paiement", "montant"],
    "sinistres": ["date_sinistre", "montant_estime", "statut_sinistre", "fraud_score"],
}

#: Columns that may leave the platform; everything else is sensitive or free text.
PUBLIC_COLUMNS = {
    "clients": ["client_id", "code_postal", "date_creation", "statut_client"],
    "contrats": CONTRACT_COLUMNS,
    "paiements": PAYMENT_COLUMNS,
    "sinistres": ["sinistre_id", "contrat_id", "date_sinistre", "montant_estime", "statut_sinistre"],
}
SENSITIVE_COLUMNS = ["num_fiscal", "email", "telephone", "adresse"]

# --- Vocabularies -----------------------------------------------------------------------------------
STATUS_WORDS = {
    "statut_client": {"ACTIVE": "ACTIF", "INACTIVE": "INACTIF", "SUSPENDED": "SUSPENDU"},
    "statut_contrat": {"ACTIVE": "ACTIF", "TERMINATED": "RESILIE", "SUSPENDED": "SUSPENDU"},
    "statut_sinistre": {
        "REPORTED": "DECLARE", "IN_PROGRESS": "EN_COURS", "CLOSED": "CLOTURE", "REJECTED": "REJETE",
    },
    "statut_transaction": {"SUCCESS": "REUSSI", "PENDING": "EN_ATTENTE", "FAILED": "ECHOUE"},
}
CHANNEL_WORDS = {"CARD": "CARTE", "BANK_TRANSFER": "VIREMENT", "DIRECT_DEBIT": "PRELEVEMENT"}
FAILED_PAYMENT = "ECHOUE"
REJECTED_CLAIM = "REJETE"
FAMILY_SHORT, FAMILY_LONG = "ASSIST", "ASSISTANCE"
EMPTY_LABEL = "(vide)"
UNKNOWN_LABEL = "(non renseigné)"
PLACEHOLDER = "NON_RENSEIGNE"

# --- Risk model -------------------------------------------------------------------------------------
FEATURES = ["montant_estime", "prime_annuelle", "jours_avant_sinistre", "nb_paiements", "nb_paiements_echoues"]
DATASET_COLUMNS = [
    "sinistre_id", "contrat_id", "montant_estime", "statut_sinistre", "type_assurance", "prime_annuelle",
    "jours_avant_sinistre", "nb_paiements", "nb_paiements_echoues", "fraud_score",
]
SUSPECT_SCORE = 70
FOLDS = 5
TREE_DEPTH = 3
