"""SQL each registered query is checked with, written apart from the Spark code.

Tables defined once (``TABLES``) become common table expressions of the queries that name them. Queries that
fit a model have no SQL: a fit is checked by the invariants in the tests.
"""

from __future__ import annotations

import re

from tandem.workload.inputs import RAW, raw_sql

# --- Expressions ----------------------------------------------------------------------------------------
_SPACE = "' ' || chr(9) || chr(10) || chr(13)"


def _t(x: str) -> str:
    return f"nullif(trim({x}, {_SPACE}), '')"


def _email(x: str) -> str:
    e = f"replace(lower({_t(x)}), '_at_', '@')"
    return f"CASE WHEN {e} LIKE '%@%' AND {e} LIKE '%.%' THEN {e} END"


def _date(x: str) -> str:
    forms = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d/%m/%Y")
    return "coalesce(" + ", ".join(f"try_strptime({_t(x)}, '{f}')" for f in forms) + ")"


def _day(x: str) -> str:
    return f"strftime({_date(x)}, '%Y-%m-%d')"


def _moment(x: str) -> str:
    return f"strftime({_date(x)}, '%Y-%m-%d %H:%M:%S')"


def _phone(x: str) -> str:
    d = rf"regexp_replace(regexp_replace({_t(x)}, '^(\+33\s*\(0\)|\+33|0033)', '0'), '[^0-9]', '', 'g')"
    pairs = " || ' ' || ".join(f"substr({d}, {i}, 2)" for i in (1, 3, 5, 7, 9))
    return f"CASE WHEN length({d}) = 10 AND substr({d}, 1, 1) = '0' THEN {pairs} END"


def _stripped(x: str) -> str:
    return rf"regexp_replace(regexp_replace({_t(x)}, '^(\+33\s*\(0\)|\+33|0033)', '0'), '[ \t\n\r.-]', '', 'g')"


def _finite(x: str) -> str:
    return f"CASE WHEN isfinite(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END"


def _digits(x: str) -> str:
    return f"replace({_phone(x)}, ' ', '')"


def _words(x: str, words: dict[str, str], rest: str | None = None) -> str:
    arms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in words.items())
    return f"CASE {x} {arms} ELSE {rest or x} END"


# Words of the delivered tables and those of the common model.
_CLIENT_WORDS = {"ACTIVE": "ACTIF", "INACTIVE": "INACTIF", "SUSPENDED": "SUSPENDU"}
_CONTRACT_WORDS = {"ACTIVE": "ACTIF", "TERMINATED": "RESILIE", "SUSPENDED": "SUSPENDU"}
_CLAIM_WORDS = {"REPORTED": "DECLARE", "IN_PROGRESS": "EN_COURS", "CLOSED": "CLOTURE", "REJECTED": "REJETE"}
_PAYMENT_WORDS = {"SUCCESS": "REUSSI", "PENDING": "EN_ATTENTE", "FAILED": "ECHOUE"}
_CHANNELS = {"CARD": "CARTE", "BANK_TRANSFER": "VIREMENT", "DIRECT_DEBIT": "PRELEVEMENT"}


def _first(table: str, keys: str, columns: list[str], first: str = "") -> str:
    """One row per key: by the columns named first, then by all others; nulls come first."""
    order = ", ".join(f"{c} NULLS FIRST" for c in [*(f for f in first.split() if f in columns), *columns])
    return (
        f"SELECT {', '.join(columns)} FROM {table} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
    )


# --- Tables ---------------------------------------------------------------------------------------------
CLIENTS = (
    "client_id nom_prenom date_naissance email telephone adresse code_postal num_fiscal date_creation "
    "statut_client loyalty_score"
).split()
CONTRACTS = (
    "contrat_id client_id type_assurance code_produit date_debut date_fin prime_annuelle prime_mensuelle "
    "statut_contrat agence_id code_courtier"
).split()
PAYMENTS = "paiement_id contrat_id date_paiement montant mode_paiement statut_transaction".split()
CLAIMS = (
    "sinistre_id contrat_id date_sinistre montant_estime statut_sinistre description fraud_score"
).split()
COLUMNS = {"clients": CLIENTS, "contracts": CONTRACTS, "payments": PAYMENTS, "claims": CLAIMS}
ORDER = {
    "clients": "date_creation nom_prenom date_naissance",
    "contracts": "type_assurance code_produit date_debut prime_annuelle prime_mensuelle",
    "payments": "statut_transaction date_paiement montant",
    "claims": "date_sinistre montant_estime statut_sinistre fraud_score",
}
KEYS = {
    "clients": "client_id, email", "contracts": "contrat_id, client_id", "payments": "paiement_id, contrat_id",
    "claims": "sinistre_id, contrat_id",
}

TABLES: dict[str, str] = {f"raw_{name}": raw_sql(name) for name in RAW}
TABLES |= {
    "clean_A_clients": f"""
SELECT ab_client_id, {_t("ab_nom")} AS ab_nom, {_t("ab_prenom")} AS ab_prenom,
  {_day("ab_date_naissance")} AS ab_date_naissance, {_email("ab_email")} AS ab_email,
  {_t("ab_telephone")} AS ab_telephone, {_t("ab_adresse")} AS ab_adresse, {_t("ab_code_postal")} AS ab_code_postal,
  {_t("ab_num_fiscal")} AS ab_num_fiscal, {_moment("ab_date_creation")} AS ab_date_creation,
  {_t("ab_statut_client")} AS ab_statut_client FROM raw_A_clients""",
    "clean_B_clients": f"""
SELECT ap_user_id, {_t("ap_full_name")} AS ap_full_name, {_day("ap_birth_date")} AS ap_birth_date,
  {_email("ap_mail_address")} AS ap_mail_address, {_t("ap_phone_number")} AS ap_phone_number,
  {_t("ap_street_address")} AS ap_street_address, {_t("ap_zip_code")} AS ap_zip_code,
  {_moment("ap_created_at")} AS ap_created_at, {_t("ap_customer_status")} AS ap_customer_status, ap_loyalty_score
FROM raw_B_clients""",
    "clean_A_contracts": "SELECT * FROM raw_A_contracts",
    "clean_B_contracts": "SELECT * FROM raw_B_contracts",
    "clean_A_payments": f"SELECT * REPLACE ({_day('ab_date_paiement')} AS ab_date_paiement) FROM raw_A_payments",
    "clean_B_payments": f"""
SELECT * REPLACE ({_moment('ap_payment_datetime')} AS ap_payment_datetime) FROM raw_B_payments""",
    "clean_A_claims": f"SELECT * REPLACE ({_moment('ab_date_sinistre')} AS ab_date_sinistre) FROM raw_A_claims",
    "clean_B_claims": f"SELECT * REPLACE ({_day('ap_incident_date')} AS ap_incident_date) FROM raw_B_claims",
    "fused_clients": """
SELECT 'AB-' || ab_client_id AS client_id, ab_nom || '_' || ab_prenom AS nom_prenom,
  ab_date_naissance AS date_naissance, ab_email AS email, ab_telephone AS telephone, ab_adresse AS adresse,
  ab_code_postal AS code_postal, ab_num_fiscal AS num_fiscal, ab_date_creation AS date_creation,
  ab_statut_client AS statut_client, CAST(NULL AS VARCHAR) AS loyalty_score, 'A' AS source FROM clean_A_clients
UNION ALL
SELECT 'AP-' || ap_user_id, ap_full_name, ap_birth_date, ap_mail_address, ap_phone_number, ap_street_address,
  ap_zip_code, NULL, ap_created_at, ap_customer_status, ap_loyalty_score, 'B' FROM clean_B_clients""",
    "fused_contracts": """
SELECT ab_policy_number AS contrat_id, 'AB-' || ab_client_id AS client_id, ab_type_assurance AS type_assurance,
  CAST(NULL AS VARCHAR) AS code_produit, ab_date_debut AS date_debut, ab_date_fin AS date_fin,
  TRY_CAST(ab_prime_annuelle AS DOUBLE) AS prime_annuelle, CAST(NULL AS DOUBLE) AS prime_mensuelle,
  ab_statut_contrat AS statut_contrat, ab_agence_id AS agence_id, CAST(NULL AS VARCHAR) AS code_courtier,
  'A' AS source FROM clean_A_contracts
UNION ALL
SELECT ap_contract_ref, 'AP-' || ap_user_id, NULL, ap_product_code, ap_start_date, ap_end_date, NULL,
  TRY_CAST(ap_monthly_premium AS DOUBLE), ap_contract_state, NULL, ap_broker_code, 'B' FROM clean_B_contracts""",
    "fused_payments": """
SELECT ab_payment_id AS paiement_id, ab_policy_number AS contrat_id, ab_date_paiement AS date_paiement,
  TRY_CAST(ab_montant AS DOUBLE) AS montant, ab_mode_paiement AS mode_paiement,
  CAST(NULL AS VARCHAR) AS statut_transaction, 'A' AS source FROM clean_A_payments
UNION ALL
SELECT ap_payment_ref, ap_contract_ref, ap_payment_datetime, TRY_CAST(ap_amount_paid AS DOUBLE),
  ap_payment_channel, ap_transaction_status, 'B' FROM clean_B_payments""",
    "fused_claims": """
SELECT TRY_CAST(ab_claim_id AS BIGINT) AS sinistre_id, ab_policy_number AS contrat_id,
  ab_date_sinistre AS date_sinistre, TRY_CAST(ab_montant_estime AS DOUBLE) AS montant_estime,
  ab_statut_sinistre AS statut_sinistre, ab_description AS description, CAST(NULL AS VARCHAR) AS fraud_score,
  'A' AS source FROM clean_A_claims
UNION ALL
SELECT TRY_CAST(ap_sinistre_num AS BIGINT), ap_contract_ref, ap_incident_date,
  TRY_CAST(ap_estimated_amount AS DOUBLE), ap_claim_status, ap_claim_comment, ap_fraud_score, 'B'
FROM clean_B_claims""",
}
_NUMERIC = {"prime_annuelle", "prime_mensuelle", "montant", "sinistre_id", "montant_estime"}
_STATUS = {
    "statut_client": _CLIENT_WORDS, "statut_contrat": _CONTRACT_WORDS, "statut_sinistre": _CLAIM_WORDS,
    "statut_transaction": _PAYMENT_WORDS,
}


def _tidy(columns: list[str], table: str) -> str:
    parts = []
    for c in columns:
        x = c if c in _NUMERIC else _t(c)
        parts.append(f"{_words(x, _STATUS[c]) if c in _STATUS else x} AS {c}")
    return f"SELECT {', '.join(parts)} FROM {table}"


for _name, _cols in COLUMNS.items():
    TABLES[f"tidy_{_name}"] = _tidy(_cols, f"fused_{_name}")

_FAMILY = "coalesce(type_assurance, split_part(code_produit, '_', 1))"
_FAMILY = f"CASE WHEN {_FAMILY} = 'ASSIST' THEN 'ASSISTANCE' ELSE {_FAMILY} END"
_YEARLY = "coalesce(nullif(prime_annuelle, 0), prime_mensuelle * 12)"
_CLAIM_IN = "sinistre_id contrat_id date_sinistre montant_estime statut_sinistre fraud_score".split()
_CONTRACT_IN = (
    "contrat_id client_id type_assurance code_produit date_debut prime_annuelle prime_mensuelle"
).split()

TABLES |= {
    "some_claims": _first("tidy_claims", KEYS["claims"], _CLAIM_IN, ORDER["claims"]),
    "some_contracts": _first("tidy_contracts", KEYS["contracts"], _CONTRACT_IN, ORDER["contracts"]),
    "some_payments": _first("tidy_payments", KEYS["payments"], PAYMENTS, ORDER["payments"]),
    "paid": """
SELECT contrat_id, count(*) AS nb_paiements, count(*) FILTER (statut_transaction = 'ECHOUE') AS nb_paiements_echoues
FROM some_payments GROUP BY contrat_id""",
    "linked": f"""
SELECT s.sinistre_id, s.contrat_id, coalesce(s.montant_estime, 0) AS montant_estime, s.statut_sinistre,
  {_FAMILY} AS type_assurance, {_YEARLY} AS prime_annuelle,
  CAST(date_diff('day', CAST(TRY_CAST(c.date_debut AS TIMESTAMP) AS DATE),
    CAST(TRY_CAST(s.date_sinistre AS TIMESTAMP) AS DATE)) AS INT) AS jours_avant_sinistre,
  coalesce(p.nb_paiements, 0) AS nb_paiements, coalesce(p.nb_paiements_echoues, 0) AS nb_paiements_echoues,
  s.fraud_score, c.client_id
FROM some_claims s LEFT JOIN some_contracts c USING (contrat_id) LEFT JOIN paid p USING (contrat_id)""",
    "dataset": """
SELECT * EXCLUDE (client_id) FROM linked WHERE montant_estime > 0 AND jours_avant_sinistre >= 0""",
    "training": """
SELECT *, CASE WHEN TRY_CAST(fraud_score AS DOUBLE) >= 70 THEN 1 ELSE 0 END AS est_suspect
FROM dataset WHERE fraud_score IS NOT NULL""",
    "unscored": "SELECT * FROM dataset WHERE fraud_score IS NULL",
}


def _features(table: str, factor: str = "") -> str:
    names = ["montant_estime", "prime_annuelle", "jours_avant_sinistre", "nb_paiements", "nb_paiements_echoues"]
    parts = [f"coalesce(CAST({n} AS DOUBLE), 0)" for n in names]
    parts[0] += factor
    return f"SELECT * REPLACE ({', '.join(f'{p} AS {n}' for p, n in zip(parts, names))}) FROM {table}"


_TREE = """CASE WHEN prime_annuelle <= 250000
  THEN CASE WHEN montant_estime <= 30000 THEN 2 / 10 ELSE 7 / 10 END
  WHEN jours_avant_sinistre <= 400.5
  THEN CASE WHEN nb_paiements_echoues <= 1.5 THEN 5 / 10 ELSE CAST(11.25 AS DOUBLE) / CAST(11.75 AS DOUBLE) END
  ELSE 0 END"""


def _score(table: str, factor: str = "") -> str:
    return (
        f"SELECT *, CAST(proba_fraude > 0.5 AS INT) AS suspect "
        f"FROM (SELECT *, CAST({_TREE} AS DOUBLE) AS proba_fraude FROM ({_features(table, factor)}))"
    )


TABLES |= {
    "scored": f"""
SELECT sinistre_id, contrat_id, montant_estime, prime_annuelle, jours_avant_sinistre, nb_paiements,
  nb_paiements_echoues, proba_fraude, suspect FROM ({_score("unscored")})""",
    "factors": "SELECT 0.5 AS facteur UNION ALL SELECT 2.0",
    "folds": """
SELECT sinistre_id, contrat_id, est_suspect, CAST(row_number() OVER (PARTITION BY est_suspect
  ORDER BY md5(concat_ws('|', sinistre_id, contrat_id, '42')), sinistre_id, contrat_id) % 5 AS INT) AS pli
FROM training""",
    "payment_messages": """
SELECT key, value, json_valid(value) AND json_type(CASE WHEN json_valid(value) THEN value END, '$.montant')
  <> 'VARCHAR' AS good FROM raw_messages""",
    "good_messages": """
SELECT value ->> '$.paiement_id' AS paiement_id, value ->> '$.contrat_id' AS contrat_id,
  value ->> '$.date_paiement' AS date_paiement, CAST(value ->> '$.montant' AS DOUBLE) AS montant,
  value ->> '$.mode_paiement' AS mode_paiement, value ->> '$.statut_transaction' AS statut_transaction
FROM payment_messages WHERE good""",
    "log_lines": r"""
SELECT CAST(regexp_extract(value, '^(.*?) \| (.*?) \| (.*?) \| (.*)$', 1) AS TIMESTAMP) AS date,
  regexp_extract(value, '^(.*?) \| (.*?) \| (.*?) \| (.*)$', 2) AS niveau,
  regexp_extract(value, '^(.*?) \| (.*?) \| (.*?) \| (.*)$', 3) AS service,
  regexp_extract(value, '^(.*?) \| (.*?) \| (.*?) \| (.*)$', 4) AS message
FROM raw_status_lines""",
}

# --- Queries --------------------------------------------------------------------------------------------
_TEMPLATES: dict[str, str] = {
    "claim_dataset": "SELECT * FROM dataset",
    "linked_claims": "SELECT * FROM linked",
    "discarded_claims": """
SELECT sinistre_id, contrat_id, CASE WHEN montant_estime <= 0 THEN 'montant_estime'
  WHEN jours_avant_sinistre IS NULL THEN 'date' ELSE 'jours_avant_sinistre' END AS motif
FROM linked WHERE montant_estime <= 0 OR jours_avant_sinistre IS NULL OR jours_avant_sinistre < 0""",
    "training_rows": "SELECT * FROM training",
    "rows_to_predict": "SELECT * FROM unscored",
    "label_counts": "SELECT est_suspect, count(*) AS nb FROM training GROUP BY est_suspect",
    "stored_dataset_counts": """
SELECT 1 AS note_connue, est_suspect, count(*) AS nb FROM training GROUP BY est_suspect
UNION ALL SELECT 0, NULL, count(*) FROM unscored""",
    "payment_summary": "SELECT * FROM paid",
    "blank_to_null": f"""
SELECT {', '.join(f"{_t(c)} AS {c}" for c in (
    "ab_client_id ab_nom ab_prenom ab_date_naissance ab_email ab_telephone ab_adresse ab_code_postal "
    "ab_num_fiscal ab_date_creation ab_statut_client").split())} FROM raw_A_clients""",
    "normal_phones": f"SELECT ab_client_id, ab_telephone, {_phone('ab_telephone')} AS telephone FROM raw_A_clients",
    "unread_dates": "SELECT " + ", ".join(
        f"count(*) FILTER ({_t(c)} IS NOT NULL AND {_date(c)} IS NULL) AS {c}"
        for c in ("ap_birth_date", "ap_created_at")
    ) + " FROM raw_B_clients",
    "amounts_from_text": f"""
SELECT ap_contract_ref, ap_user_id, TRY_CAST({_t("ap_monthly_premium")} AS DOUBLE) AS prime_mensuelle
FROM raw_B_contracts""",
    "client_statuses": f"""
SELECT client_id, nom_prenom, {_words("statut_client", _CLIENT_WORDS)} AS statut_client FROM fused_clients""",
    "contract_statuses": f"""
SELECT contrat_id, client_id, {_words("statut_contrat", _CONTRACT_WORDS)} AS statut_contrat FROM fused_contracts""",
    "claim_statuses": f"""
SELECT sinistre_id, contrat_id, {_words("statut_sinistre", _CLAIM_WORDS)} AS statut_sinistre FROM fused_claims""",
    "payment_statuses": f"""
SELECT {_words("statut_transaction", _PAYMENT_WORDS)} AS statut_transaction, count(*) AS nb
FROM fused_payments GROUP BY 1""",
    "payment_channels": f"""
SELECT {_words(_t("mode_paiement"), _CHANNELS)} AS mode_paiement, count(*) AS nb FROM fused_payments GROUP BY 1""",
    "completed_contracts": f"""
SELECT * REPLACE ({_YEARLY} AS prime_annuelle, {_FAMILY} AS type_assurance) FROM tidy_contracts""",
    # Exact cents, halves rounded away from zero.
    "filled_premiums": """
SELECT contrat_id, client_id, coalesce(y, m * 12) / 100 AS prime_annuelle,
  coalesce(m, sign(y) * ((2 * abs(y) + 12) // 24)) / 100 AS prime_mensuelle
FROM (SELECT contrat_id, client_id, CAST(round(prime_annuelle * 100) AS BIGINT) AS y,
  CAST(round(prime_mensuelle * 100) AS BIGINT) AS m FROM fused_contracts)""",
    "claim_number_offset": """
SELECT source, CASE source WHEN 'A' THEN sinistre_id
  ELSE sinistre_id + (SELECT max(sinistre_id) FROM fused_claims WHERE source = 'A') END AS sinistre_id, contrat_id
FROM fused_claims""",
    "merged_clients": """
SELECT *, email IS NOT NULL AND row_number() OVER (PARTITION BY lower(email) ORDER BY source, client_id) > 1
  AS doublon FROM fused_clients""",
    "prepared_clients": """
SELECT client_id, nom_prenom, date_naissance, email, telephone, statut_client, date_creation, loyalty_score
FROM (""" + _first("tidy_clients", "client_id", CLIENTS, ORDER["clients"]) + ")",
    "prepared_contracts": f"""
SELECT contrat_id, client_id, {_FAMILY} AS famille_produit, {_YEARLY} AS prime_annuelle_eq, statut_contrat,
  TRY_CAST(date_debut AS TIMESTAMP) AS date_debut, TRY_CAST(date_fin AS TIMESTAMP) AS date_fin,
  CAST(date_diff('day', TRY_CAST(date_debut AS TIMESTAMP), TRY_CAST(date_fin AS TIMESTAMP)) AS INT)
    AS duree_contrat_jours
FROM ({_first("tidy_contracts", "contrat_id", CONTRACTS, ORDER["contracts"])})""",
    "prepared_payments": f"""
SELECT contrat_id, count(*) AS nb_paiements, CAST(sum(TRY_CAST(montant AS DECIMAL(18,2))) AS DOUBLE) AS total_paye,
  count(*) FILTER (statut_transaction = 'ECHOUE') AS nb_paiements_echoues
FROM ({_first("tidy_payments", "paiement_id", PAYMENTS, ORDER["payments"])}) GROUP BY contrat_id""",
    "prepared_claims": f"""
SELECT contrat_id, count(*) AS nb_sinistres,
  CAST(sum(TRY_CAST(montant_estime AS DECIMAL(18,2))) AS DOUBLE) AS total_sinistres,
  count(*) FILTER (statut_sinistre = 'REJETE') AS nb_sinistres_rejetes
FROM ({_first("tidy_claims", "sinistre_id", CLAIMS, ORDER["claims"])}) GROUP BY contrat_id""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{e}' AS \"table\", count(*) AS \"rows\" FROM fused_{t}"
        for t, e in (("clients", "clients"), ("contracts", "contrats"), ("payments", "paiements"),
                     ("claims", "sinistres"))
    ),
    "contracts_by_status": """
SELECT coalesce(statut_contrat, '(vide)') AS statut_contrat, count(*) AS nb FROM tidy_contracts
GROUP BY 1 ORDER BY nb DESC, 1""",
    "contracts_by_status_and_type": """
SELECT coalesce(statut_contrat, '(vide)') AS statut_contrat,
  coalesce(type_assurance, '(non renseigné)') AS type_assurance, count(*) AS nb FROM tidy_contracts GROUP BY 1, 2""",
    "active_contracts_by_type": """
SELECT coalesce(type_assurance, '(non renseigné)') AS type_assurance, count(*) AS nb FROM tidy_contracts
WHERE statut_contrat = 'ACTIF' GROUP BY 1""",
    "total_claim_amount": """
SELECT CAST(coalesce(sum(CAST(montant_estime AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_sinistres
FROM fused_claims""",
    "public_clients": "SELECT client_id, code_postal, date_creation, statut_client FROM fused_clients",
    "exported_clients": "SELECT client_id, code_postal, date_creation, statut_client FROM fused_clients",
    "compiled_scores": "SELECT * FROM scored",
    "claims_to_watch": """
SELECT * FROM scored WHERE proba_fraude >= 0.5 ORDER BY proba_fraude DESC, sinistre_id, contrat_id""",
    "flagged_share": """
SELECT count(*) FILTER (proba_fraude >= 0.5) AS nb_signales, count(*) AS nb_total FROM scored""",
    "scores_in_percent": """
SELECT sinistre_id, contrat_id, CAST(round_even(proba_fraude * 100, 0) AS INT) AS "proba_fraude (%)" FROM scored""",
    "what_if_scores": f"""
SELECT sinistre_id, contrat_id, CAST(facteur AS DOUBLE) AS facteur, montant_estime, proba_fraude, suspect
FROM ({_score("(SELECT * FROM dataset CROSS JOIN factors)", " * CAST(facteur AS DOUBLE)")})""",
    "tree_metrics": f"""
SELECT count(*) AS nb_lignes, count(*) FILTER (est_suspect = 1) AS nb_suspects,
  coalesce(count(*) FILTER (est_suspect = 1 AND suspect = 1) / nullif(count(*) FILTER (suspect = 1), 0), 0)
    AS precision_suspects,
  coalesce(count(*) FILTER (est_suspect = 1 AND suspect = 1) / nullif(count(*) FILTER (est_suspect = 1), 0), 0)
    AS rappel_suspects
FROM ({_score("training")})""",
    "class_weights": """
SELECT CAST(est_suspect AS DOUBLE) AS label, CASE est_suspect WHEN 1
  THEN (SELECT count(*) FILTER (est_suspect = 0) / count(*) FILTER (est_suspect = 1) FROM training)
  ELSE 1.0 END AS poids, count(*) AS nb FROM training GROUP BY 1, 2""",
    "stratified_folds": "SELECT * FROM folds",
    "fold_sizes": "SELECT est_suspect, pli, count(*) AS nb FROM folds GROUP BY 1, 2",
    "incoherent_clients": r"""
SELECT client_id, statut_client, date_creation FROM fused_clients
WHERE NOT coalesce(upper(trim(statut_client)) IN
    ('ACTIF', 'INACTIF', 'SUSPENDU', 'ACTIVE', 'INACTIVE', 'SUSPENDED')
  AND regexp_full_match(trim(date_creation), '\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?'), false)""",
    "read_messages": "SELECT * FROM good_messages",
    "landed_payments": "SELECT * FROM good_messages",
    "landed_after_restart": "SELECT * FROM good_messages",
    "landed_after_replay": "SELECT * FROM good_messages",
    "malformed_messages": "SELECT value AS message FROM payment_messages WHERE NOT coalesce(good, false)",
    "landed_quarantine": "SELECT value AS message FROM payment_messages WHERE NOT coalesce(good, false)",
    "rows_lost_to_nulls": """
SELECT count(*) FILTER (NOT json_valid(value)) AS nb_lignes_vides FROM raw_messages""",
    "landed_protected_clients": """
SELECT client_id, nom_prenom, date_naissance, sha256('cle' || email) AS email,
  sha256('cle' || telephone) AS telephone, sha256('cle' || adresse) AS adresse, code_postal,
  sha256('cle' || num_fiscal) AS num_fiscal, date_creation, statut_client, loyalty_score FROM out_clients""",
    "step_durations": """
SELECT etape, count(*) AS nb_mesures, min(c) / 100 AS minimum_s,
  ((2 * sum(m) + 10000 * count(*)) // (20000 * count(*))) / 100 AS moyenne_s, max(c) / 100 AS maximum_s
FROM (SELECT etape, CAST(round(duree_s * 1000000) AS HUGEINT) AS m, CAST(round(duree_s * 100) AS BIGINT) AS c
  FROM raw_timings) GROUP BY etape""",
    "slow_steps": """
SELECT etape, nb_mesures, last AS derniere_s, moyenne_avant_s,
  last > 1.5 * moyenne_avant_s AND last > 0.5 AS ralenti
FROM (SELECT etape, count(*) AS nb_mesures, CAST(max_by(s, (date, event_id)) AS DOUBLE) AS last,
    CAST(sum(s) - max_by(s, (date, event_id)) AS DOUBLE) / (count(*) - 1) AS moyenne_avant_s
  FROM (SELECT *, CAST(duree_s AS DECIMAL(18,6)) AS s FROM raw_timings) GROUP BY etape)""",
    "step_names": "SELECT etape, min(date) AS premiere FROM raw_timings GROUP BY etape ORDER BY premiere, etape",
    "step_history": "SELECT * FROM raw_timings WHERE etape = 'purchase' ORDER BY date, event_id",
    "newest_status_lines": "SELECT * FROM log_lines ORDER BY date DESC, message LIMIT 40",
    "status_counts": "SELECT service, niveau, count(*) AS nb FROM log_lines GROUP BY 1, 2",
    "status_log_file": "SELECT service, niveau, count(*) AS nb FROM log_lines GROUP BY 1, 2",
    "typed_file_rows": """
SELECT ap_contract_ref, CAST(ap_user_id AS BIGINT) AS ap_user_id, ap_product_code,
  ap_start_date, ap_end_date,
  TRY_CAST(ap_monthly_premium AS DOUBLE) AS ap_monthly_premium,
  nullif(ap_contract_state, '') AS ap_contract_state, ap_broker_code
FROM raw_B_contracts WHERE ap_monthly_premium <> 'n/a'""",
    "typed_file_rejects": """
SELECT ap_contract_ref, ap_user_id, 'ap_monthly_premium' AS colonnes FROM raw_B_contracts
WHERE ap_monthly_premium = 'n/a'""",
    # A blank field of a file is read as null.
    "text_file_rows": """
SELECT ab_claim_id, ab_policy_number, nullif(ab_date_sinistre, '') AS ab_date_sinistre, ab_montant_estime,
  ab_statut_sinistre, nullif(ab_description, '') AS ab_description FROM raw_A_claims""",
    "spreadsheet_lines": """
SELECT concat_ws(';', sinistre_id, contrat_id, CAST(round_even(proba_fraude * 100, 0) AS INT)) AS value
FROM scored WHERE proba_fraude >= 0.5""",
    "landed_checks": 'SELECT "table", "rows", "rows" > 0 AS ok FROM checked_tables',
    "failed_checks": """
SELECT count(*) AS nb_pannes, string_agg("table", ', ' ORDER BY "table") AS pannes FROM checked_tables
WHERE "rows" = 0""",
}
_TEMPLATES["timings_file"] = _TEMPLATES["step_durations"]
TABLES["checked_tables"] = (
    _TEMPLATES["table_counts"]
    + " UNION ALL SELECT 'remboursements', count(*) FILTER (montant < 0) FROM fused_payments"
)

for _name in list(RAW)[:8]:
    _TEMPLATES[f"clean_{_name}"] = f"SELECT * FROM clean_{_name}"
for _name, _cols in COLUMNS.items():
    _TEMPLATES[f"fused_{_name}"] = f"SELECT * FROM fused_{_name}"
    _TEMPLATES[f"unique_{_name}"] = _first(f"tidy_{_name}", KEYS[_name], _cols, ORDER[_name])

# Row numbers over whole rows: the first by all columns is unique, the others are repeats.
_SOURCE_KEYS = {
    "A_clients": "ab_client_id", "B_clients": "ap_user_id", "A_contracts": "ab_policy_number",
    "B_contracts": "ap_contract_ref", "A_payments": "ab_payment_id", "B_payments": "ap_payment_ref",
    "A_claims": "ab_claim_id", "B_claims": "ap_sinistre_num",
}
_SOURCE_NAMES = {
    "AB_CLIENT": "A_clients", "AB_CONTRAT": "A_contracts", "AB_PAIEMENT": "A_payments", "AB_SINISTRE": "A_claims",
    "AP_USERS": "B_clients", "AP_CONTRACTS": "B_contracts", "AP_PAYMENTS": "B_payments", "AP_CLAIMS": "B_claims",
}


def _source_columns(table: str) -> list[str]:
    """Column names of a derived source table, from the aliases of its SELECT."""
    return re.findall(r"\bAS\s+((?:ab|ap)_\w+)", RAW[table])


def _ranked(table: str, source: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in _source_columns(table))
    key = _SOURCE_KEYS[table]
    return (
        f"SELECT *, row_number() OVER (PARTITION BY lower({key}) ORDER BY {order}) AS rn, "
        f"count(*) OVER (PARTITION BY lower({key})) AS copies FROM {source}_{table}"
    )


for _name, _key in _SOURCE_KEYS.items():
    _TEMPLATES[f"split_{_name}"] = (
        f"SELECT * EXCLUDE (rn, copies), rn > 1 AS doublon FROM ({_ranked(_name, 'clean')})"
    )
_TEMPLATES["repeated_claims"] = f"SELECT * EXCLUDE (rn, copies) FROM ({_ranked('A_claims', 'clean')}) WHERE rn > 1"
_TEMPLATES["duplicate_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(DISTINCT lower({_SOURCE_KEYS[t]})) AS nb_uniques, "
    f"count(*) - count(DISTINCT lower({_SOURCE_KEYS[t]})) AS nb_doublons FROM raw_{t}"
    for name, t in _SOURCE_NAMES.items()
)
for _name, _cols in (
    ("clients", ["client_id", "code_postal", "date_creation", "statut_client"]),
    ("contracts", CONTRACTS),
    ("payments", PAYMENTS),
    ("claims", ["sinistre_id", "contrat_id", "date_sinistre", "montant_estime", "statut_sinistre"]),
):
    _order = ", ".join(f"{c} NULLS FIRST" for c in _cols)
    _TEMPLATES[f"preview_{_name}"] = f"SELECT {', '.join(_cols)} FROM fused_{_name} ORDER BY {_order} LIMIT 10"
_TEMPLATES["fusion_control"] = " UNION ALL ".join(
    f"SELECT '{e}' AS table_cible, (SELECT count(*) FROM raw_A_{t}) AS nb_lignes_a, "
    f"(SELECT count(*) FROM raw_B_{t}) AS nb_lignes_b, count(*) AS nb_lignes_finales, "
    f"(SELECT count(*) FROM fused_{t}) - count(*) AS nb_doublons_fusionnes "
    f"FROM (SELECT DISTINCT {KEYS[t]} FROM fused_{t})"
    for t, e in (("clients", "clients"), ("contracts", "contrats"), ("payments", "paiements"),
                 ("claims", "sinistres"))
)

# --- Messages -------------------------------------------------------------------------------------------
_UPPER = f"upper({_t('statut_client')})"
_CLIENT_OUT = _words(_UPPER, {**_CLIENT_WORDS, **{w: w for w in _CLIENT_WORDS.values()}}, _t("statut_client"))
TABLES["out_clients"] = f"""
SELECT {', '.join(CLIENTS)} FROM
  (SELECT * REPLACE ({_phone("telephone")} AS telephone, {_CLIENT_OUT} AS statut_client) FROM fused_clients)"""
TABLES["out_contracts"] = f"""
SELECT {', '.join(CONTRACTS)} FROM (SELECT * REPLACE (
  {_words(f"upper({_t('statut_contrat')})", _CONTRACT_WORDS)} AS statut_contrat) FROM fused_contracts)"""
TABLES["out_payments"] = f"SELECT {', '.join(PAYMENTS)} FROM fused_payments"
TABLES["out_claims"] = f"SELECT {', '.join(CLAIMS)} FROM fused_claims"
TABLES["out_zero_contracts"] = """
SELECT * REPLACE (coalesce(prime_annuelle, 0) AS prime_annuelle, coalesce(prime_mensuelle, 0) AS prime_mensuelle)
FROM out_contracts"""


def _messages(table: str, columns: list[str]) -> str:
    return f"SELECT CAST({columns[0]} AS VARCHAR) AS key, CAST(to_json(o) AS VARCHAR) AS value FROM {table} o"


for _name, _cols in COLUMNS.items():
    _TEMPLATES[f"messages_{_name}"] = _messages(f"out_{_name}", _cols)
_TEMPLATES["messages_with_zero_premiums"] = _messages("out_zero_contracts", CONTRACTS)
_TEMPLATES["publish_control"] = " UNION ALL ".join(
    f"SELECT 'assurance.{e}.v1' AS topic, count(*) AS tentes, count(*) AS reussis, count(*) - count(*) AS echoues FROM fused_{t}"
    for t, e in (("clients", "clients"), ("contracts", "contrats"), ("payments", "paiements"),
                 ("claims", "sinistres"))
)


# --- Quality rules --------------------------------------------------------------------------------------
def _blank(c: str) -> str:
    return f"{_t(c)} IS NULL"


def _bad_date(c: str) -> str:
    return f"{_date(c)} IS NULL"


def _bad_amount(c: str) -> str:
    return f"coalesce(TRY_CAST({_t(c)} AS DOUBLE) < 0, true)"


def _no_number(c: str) -> str:
    return f"TRY_CAST({_t(c)} AS DOUBLE) IS NULL"


def _off_form(c: str) -> str:
    return f"({_date(c)} IS NOT NULL AND contains({c}, '/'))"


def _off_phone(c: str) -> str:
    return f"({_t(c)} IS NOT NULL AND {_stripped(c)} <> {_t(c)})"


def _off_zip(c: str) -> str:
    return f"NOT coalesce(regexp_full_match({_t(c)}, '[0-9]{{5}}'), false)"


def _not_in(c: str, words: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words.split())
    return f"NOT coalesce({_t(c)} IN ({listed}), false)"


def _ends_before(end: str, start: str) -> str:
    return f"coalesce({_date(end)} < {_date(start)}, false)"


#: Source table -> rule name -> (severity, condition).
_RULES: dict[str, dict[str, tuple[str, str]]] = {
    "AB_CLIENT": {
        "ab_nom:empty": ("reject", _blank("ab_nom")),
        "ab_prenom:empty": ("reject", _blank("ab_prenom")),
        "ab_date_naissance:bad_date": ("reject", _bad_date("ab_date_naissance")),
        "ab_num_fiscal:empty": ("reject", _blank("ab_num_fiscal")),
        "ab_date_creation:bad_date": ("reject", _bad_date("ab_date_creation")),
        "ab_date_naissance:date_form": ("correct", _off_form("ab_date_naissance")),
        "ab_email:empty": ("correct", _blank("ab_email")),
        "ab_email:misspelt_email": ("correct", "contains(ab_email, '_at_')"),
        "ab_telephone:empty": ("correct", _blank("ab_telephone")),
        "ab_telephone:phone_form": ("correct", _off_phone("ab_telephone")),
        "ab_adresse:empty": ("correct", _blank("ab_adresse")),
        "ab_date_creation:date_form": ("correct", _off_form("ab_date_creation")),
        "ab_email:bad_email": ("flag", f"({_t('ab_email')} IS NOT NULL AND ({_email('ab_email')}) IS NULL)"),
        "ab_code_postal:bad_postcode": ("flag", _off_zip("ab_code_postal")),
        "ab_statut_client:other_word": ("flag", _not_in("ab_statut_client", "ACTIF INACTIF SUSPENDU")),
    },
    "AB_CONTRAT": {
        "ab_client_id:empty": ("reject", _blank("ab_client_id")),
        "ab_type_assurance:empty": ("reject", _blank("ab_type_assurance")),
        "ab_date_debut:bad_date": ("reject", _bad_date("ab_date_debut")),
        "ab_date_fin:bad_date": ("reject", _bad_date("ab_date_fin")),
        "ab_prime_annuelle:bad_amount": ("reject", _bad_amount("ab_prime_annuelle")),
        "ab_date_debut:date_form": ("correct", _off_form("ab_date_debut")),
        "ab_date_fin:date_form": ("correct", _off_form("ab_date_fin")),
        "ab_agence_id:empty": ("correct", _blank("ab_agence_id")),
        "ab_date_fin:ends_before": ("flag", _ends_before("ab_date_fin", "ab_date_debut")),
        "ab_statut_contrat:other_word": ("flag", _not_in("ab_statut_contrat", "ACTIF RESILIE SUSPENDU")),
    },
    "AB_PAIEMENT": {
        "ab_policy_number:empty": ("reject", _blank("ab_policy_number")),
        "ab_date_paiement:bad_date": ("reject", _bad_date("ab_date_paiement")),
        "ab_montant:bad_amount": ("reject", _bad_amount("ab_montant")),
        "ab_date_paiement:date_form": ("correct", _off_form("ab_date_paiement")),
        "ab_mode_paiement:empty": ("correct", _blank("ab_mode_paiement")),
    },
    "AB_SINISTRE": {
        "ab_policy_number:empty": ("reject", _blank("ab_policy_number")),
        "ab_date_sinistre:bad_date": ("reject", _bad_date("ab_date_sinistre")),
        "ab_montant_estime:bad_amount": ("reject", _bad_amount("ab_montant_estime")),
        "ab_date_sinistre:date_form": ("correct", _off_form("ab_date_sinistre")),
        "ab_description:empty": ("correct", _blank("ab_description")),
        "ab_statut_sinistre:other_word": ("flag", _not_in("ab_statut_sinistre", "DECLARE EN_COURS CLOTURE REJETE")),
    },
    "AP_USERS": {
        "ap_full_name:empty": ("reject", _blank("ap_full_name")),
        "ap_birth_date:bad_date": ("reject", _bad_date("ap_birth_date")),
        "ap_created_at:bad_date": ("reject", _bad_date("ap_created_at")),
        "ap_birth_date:date_form": ("correct", _off_form("ap_birth_date")),
        "ap_mail_address:empty": ("correct", _blank("ap_mail_address")),
        "ap_mail_address:misspelt_email": ("correct", "contains(ap_mail_address, '_at_')"),
        "ap_phone_number:empty": ("correct", _blank("ap_phone_number")),
        "ap_phone_number:phone_form": ("correct", _off_phone("ap_phone_number")),
        "ap_street_address:empty": ("correct", _blank("ap_street_address")),
        "ap_created_at:date_form": ("correct", _off_form("ap_created_at")),
        "ap_zip_code:bad_postcode": ("flag", _off_zip("ap_zip_code")),
        "ap_customer_status:other_word": ("flag", _not_in("ap_customer_status", "ACTIVE INACTIVE SUSPENDED")),
        "ap_loyalty_score:not_a_number": ("flag", _no_number("ap_loyalty_score")),
    },
    "AP_CONTRACTS": {
        "ap_user_id:empty": ("reject", _blank("ap_user_id")),
        "ap_product_code:empty": ("reject", _blank("ap_product_code")),
        "ap_start_date:bad_date": ("reject", _bad_date("ap_start_date")),
        "ap_end_date:bad_date": ("reject", _bad_date("ap_end_date")),
        "ap_monthly_premium:bad_amount": ("reject", _bad_amount("ap_monthly_premium")),
        "ap_start_date:date_form": ("correct", _off_form("ap_start_date")),
        "ap_end_date:date_form": ("correct", _off_form("ap_end_date")),
        "ap_broker_code:empty": ("correct", _blank("ap_broker_code")),
        "ap_end_date:ends_before": ("flag", _ends_before("ap_end_date", "ap_start_date")),
        "ap_contract_state:other_word": ("flag", _not_in("ap_contract_state", "ACTIVE TERMINATED SUSPENDED")),
    },
    "AP_PAYMENTS": {
        "ap_contract_ref:empty": ("reject", _blank("ap_contract_ref")),
        "ap_payment_datetime:bad_date": ("reject", _bad_date("ap_payment_datetime")),
        "ap_amount_paid:bad_amount": ("reject", _bad_amount("ap_amount_paid")),
        "ap_payment_datetime:date_form": ("correct", _off_form("ap_payment_datetime")),
        "ap_payment_channel:empty": ("correct", _blank("ap_payment_channel")),
        "ap_transaction_status:other_word": ("flag", _not_in("ap_transaction_status", "SUCCESS PENDING FAILED")),
    },
    "AP_CLAIMS": {
        "ap_contract_ref:empty": ("reject", _blank("ap_contract_ref")),
        "ap_incident_date:bad_date": ("reject", _bad_date("ap_incident_date")),
        "ap_estimated_amount:bad_amount": ("reject", _bad_amount("ap_estimated_amount")),
        "ap_incident_date:date_form": ("correct", _off_form("ap_incident_date")),
        "ap_claim_comment:empty": ("correct", _blank("ap_claim_comment")),
        "ap_claim_status:other_word": ("flag", _not_in("ap_claim_status", "REPORTED IN_PROGRESS CLOSED REJECTED")),
        "ap_fraud_score:not_a_number": ("flag", _no_number("ap_fraud_score")),
    },
}


def _any(name: str, *severities: str) -> str:
    return "(false" + "".join(f" OR ({sql})" for s, sql in _RULES[name].values() if s in severities) + ")"


def _listed(name: str, severity: str) -> str:
    """Names of the broken rules of one severity, in the order of the rules, joined by commas."""
    arms = [f"CASE WHEN {sql} THEN '{rule}' END" for rule, (s, sql) in _RULES[name].items() if s == severity]
    return f"concat_ws(',', {', '.join(arms)})" if arms else "''"


def _report(name: str) -> str:
    table = _SOURCE_NAMES[name]
    return f"""
SELECT '{name}' AS "table", n AS nb_lignes_total, before AS nb_anomalies_avant,
  ((20000 * before + n) // (2 * n)) / 100 AS taux_anomalies_avant, refused AS nb_lignes_rejetees,
  after AS nb_anomalies_apres, ((20000 * after + n) // (2 * n)) / 100 AS taux_anomalies_apres
FROM (SELECT count(*) AS n,
    count(*) FILTER (copies > 1 OR {_any(name, "reject", "correct", "flag")}) AS before,
    count(*) FILTER (rn > 1 OR {_any(name, "reject")}) AS refused,
    count(*) FILTER (rn = 1 AND NOT {_any(name, "reject")} AND {_any(name, "flag")}) AS after
  FROM ({_ranked(table, "raw")}))"""


_TEMPLATES["quality_report"] = " UNION ALL ".join(_report(name) for name in _RULES)
_TEMPLATES["broken_rules"] = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", '{rule}' AS rule, count(*) FILTER ({sql}) AS nb FROM raw_{_SOURCE_NAMES[name]}"
    for name, rules in _RULES.items()
    for rule, (_, sql) in rules.items()
) + ") WHERE nb > 0"
_TEMPLATES["rejected_clients"] = f"""
SELECT ab_client_id, {_listed("AB_CLIENT", "reject")} AS motifs FROM raw_A_clients
WHERE {_any("AB_CLIENT", "reject")}"""
_TEMPLATES["corrected_clients"] = f"""
SELECT ab_client_id, {_day("ab_date_naissance")} AS ab_date_naissance,
  coalesce(replace({_t("ab_email")}, '_at_', '@'), 'NON_RENSEIGNE') AS ab_email,
  coalesce({_stripped("ab_telephone")}, 'NON_RENSEIGNE') AS ab_telephone,
  coalesce({_t("ab_adresse")}, 'NON_RENSEIGNE') AS ab_adresse, {_moment("ab_date_creation")} AS ab_date_creation,
  {_listed("AB_CLIENT", "flag")} AS anomalies
FROM raw_A_clients WHERE NOT {_any("AB_CLIENT", "reject")}"""


#: Columns with a stated repair: dates to days or moments, addresses, telephone numbers; all others get the placeholder.
_DAYS = (
    "ab_date_naissance ab_date_debut ab_date_fin ab_date_paiement ap_birth_date ap_incident_date"
).split()
_ADDRESSES, _PHONES = ("ab_email", "ap_mail_address"), ("ab_telephone", "ap_phone_number")


def _repaired(column: str, rules: set[str]) -> str:
    if "date_form" in rules:
        return _day(column) if column in _DAYS else _moment(column)
    value = _t(column)
    if column in _ADDRESSES:
        value = f"replace({value}, '_at_', '@')"
    if column in _PHONES:
        value = _stripped(column)
    return f"coalesce({value}, 'NON_RENSEIGNE')"


def _corrected(name: str) -> str:
    repairs: dict[str, set[str]] = {}
    for rule, (severity, _) in _RULES[name].items():
        if severity == "correct":
            column, check = rule.split(":")
            repairs.setdefault(column, set()).add(check)
    values = ", ".join(f"coalesce({_repaired(c, repairs[c])}, '')" for c in sorted(repairs))
    table = _SOURCE_NAMES[name]
    return (
        f"SELECT '{name}' AS \"table\", {_SOURCE_KEYS[table]} AS cle, concat_ws('|', {values}) AS valeurs, "
        f"{_listed(name, 'flag')} AS anomalies FROM raw_{table} WHERE NOT {_any(name, 'reject')}"
    )


_TEMPLATES["corrected_rows"] = " UNION ALL ".join(map(_corrected, _RULES))
_TEMPLATES["rejected_rows"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", {_SOURCE_KEYS[_SOURCE_NAMES[name]]} AS cle, {_listed(name, 'reject')} AS motifs "
    f"FROM raw_{_SOURCE_NAMES[name]} WHERE {_any(name, 'reject')}"
    for name in _RULES
)
_TEMPLATES["folds_of_all_claims"] = """
SELECT sinistre_id, contrat_id, est_suspect, CAST(row_number() OVER (PARTITION BY est_suspect
  ORDER BY md5(concat_ws('|', sinistre_id, contrat_id, '42')), sinistre_id, contrat_id) % 5 AS INT) AS pli
FROM (SELECT *, CASE WHEN fraud_score IS NULL THEN NULL WHEN TRY_CAST(fraud_score AS DOUBLE) >= 70 THEN 1 ELSE 0 END
  AS est_suspect FROM dataset)"""
_TEMPLATES["merged_companies"] = """
SELECT *, email IS NOT NULL AND row_number() OVER (PARTITION BY lower(email)
  ORDER BY CASE source WHEN 'B' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, client_id) > 1 AS doublon FROM raw_three_companies"""
_TEMPLATES["slow_steps_with_gaps"] = """
SELECT etape, n AS nb_mesures, CASE WHEN n >= 4 THEN last END AS derniere_s, CASE WHEN n >= 4 THEN mean END AS moyenne_avant_s,
  coalesce(n >= 4 AND last > 1.5 * mean AND last > 0.5, false) AS ralenti
FROM (SELECT etape, count(s) AS n, CAST(max_by(s, (date, event_id)) FILTER (s IS NOT NULL) AS DOUBLE) AS last,
    CAST(sum(s) - max_by(s, (date, event_id)) FILTER (s IS NOT NULL) AS DOUBLE) / nullif(count(s) - 1, 0) AS mean
  FROM (SELECT *, CAST(duree_s AS DECIMAL(18,6)) AS s FROM raw_timing_gaps) GROUP BY etape)"""
_TEMPLATES["odd_amounts"] = f"""
SELECT count(*) AS nb, count({_finite("montant")}) AS nb_lus,
  CAST(sum(CAST({_finite("montant")} AS DECIMAL(28,2))) AS DOUBLE) AS total FROM raw_odd_amounts"""
_TEMPLATES["rows_with_line_breaks"] = r"""
SELECT 'garde' AS lecture, ab_claim_id, ab_policy_number, ab_description FROM raw_long_claims
UNION ALL SELECT 'espace', ab_claim_id, ab_policy_number,
  replace(replace(ab_description, chr(13) || chr(10), ' '), chr(10), ' ') FROM raw_long_claims"""
_TEMPLATES["landed_after_switch_back"] = "SELECT * FROM good_messages"
_TEMPLATES["run_journal"] = f"{_TEMPLATES['table_counts']} UNION ALL {_TEMPLATES['table_counts']}"
_TEMPLATES["unsealed_quarantine"] = _TEMPLATES["landed_quarantine"]


def _keyed(x: str) -> str:
    key = "'cle de protection'"
    return f"sha256({key} || sha256({key} || {x}))"


_TEMPLATES["landed_clients_by_key_file"] = f"""
SELECT client_id, nom_prenom, date_naissance, {_keyed("email")} AS email, {_keyed("telephone")} AS telephone,
  {_keyed("adresse")} AS adresse, code_postal, {_keyed("num_fiscal")} AS num_fiscal, date_creation, statut_client,
  loyalty_score FROM out_clients"""
_CHANGED = """
SELECT service, date, lag(niveau) OVER w AS avant, niveau, message, lag(1) OVER w IS NULL OR lag(niveau) OVER w <> niveau AS changed
FROM log_lines WINDOW w AS (PARTITION BY service ORDER BY date, message, niveau)"""
_TEMPLATES["status_changes"] = f"SELECT * EXCLUDE (changed) FROM ({_CHANGED}) WHERE changed"
_TEMPLATES["alert_periods"] = f"""
SELECT service, date AS debut, fin, (epoch_us(fin) - epoch_us(date)) / 1000000 AS duree_s
FROM (SELECT *, lead(date) OVER (PARTITION BY service ORDER BY date, message, niveau) AS fin FROM ({_CHANGED}) WHERE changed)
WHERE niveau = 'ALERTE'"""

# --- All tables in one query: a row as text, a sign where there is no value ------------------------------


def _line(values: list[str]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({v} AS VARCHAR), '-')" for v in values)


_TEMPLATES["blanks_of_all_tables"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {_t(key)} AS cle, {_line([_t(c) for c in _source_columns(t)])} AS ligne FROM raw_{t}"
    for t, key in _SOURCE_KEYS.items()
)
# A line break in a value is written as a space, and a blank field is read as null.
_TEMPLATES["text_lines_of_all_files"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {key} AS cle, {_line([f"nullif(replace({c}, chr(10), ' '), '')" for c in _source_columns(t)])} AS ligne FROM raw_{t}"
    for t, key in _SOURCE_KEYS.items()
)
_TEMPLATES["phones_of_both_companies"] = f"""
SELECT 'A_clients' AS "table", ab_client_id AS cle, ab_telephone AS recu, {_phone("ab_telephone")} AS telephone FROM raw_A_clients
UNION ALL SELECT 'B_clients', ap_user_id, ap_phone_number, {_phone("ap_phone_number")} FROM raw_B_clients"""
_TEMPLATES["repeated_rows"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST({key} AS VARCHAR) AS cle, {_line(_source_columns(t))} AS ligne "
    f"FROM ({_ranked(t, 'clean')}) WHERE rn > 1"
    for t, key in _SOURCE_KEYS.items()
)

# Columns of the delivered files that are no text.
_DELIVERED_NUMBERS = {
    "A_clients": ["ab_client_id"], "A_contracts": ["ab_agence_id", "ab_client_id", "ab_prime_annuelle"],
    "A_payments": ["ab_montant"], "A_claims": ["ab_claim_id", "ab_montant_estime"],
    "B_clients": ["ap_loyalty_score", "ap_user_id"], "B_contracts": ["ap_monthly_premium", "ap_user_id"],
    "B_payments": ["ap_amount_paid"], "B_claims": ["ap_estimated_amount", "ap_sinistre_num"],
}
_DELIVERED_DATES = {
    "A_clients": ["ab_date_creation", "ab_date_naissance"], "A_contracts": ["ab_date_debut", "ab_date_fin"],
    "A_payments": ["ab_date_paiement"], "A_claims": ["ab_date_sinistre"], "B_clients": ["ap_birth_date", "ap_created_at"],
    "B_contracts": ["ap_end_date", "ap_start_date"], "B_payments": ["ap_payment_datetime"], "B_claims": ["ap_incident_date"],
}


def _faults(table: str) -> dict[str, str]:
    """Column -> whether a delivered value does not fit its type; an empty field is no value."""
    faults = {c: f"{c} <> '' AND TRY_CAST({c} AS DOUBLE) IS NULL" for c in _DELIVERED_NUMBERS[table]}
    for c in _DELIVERED_DATES[table]:
        day = f"trim({c}, {_SPACE})"
        faults[c] = (
            f"{c} <> '' AND try_strptime({day}, '%Y-%m-%d') IS NULL AND try_strptime({day}, '%Y-%m-%d %H:%M:%S') IS NULL"
        )
    return dict(sorted(faults.items()))


def _bad_columns(table: str) -> str:
    names = ", ".join(f"CASE WHEN {fault} THEN '{c}' END" for c, fault in _faults(table).items())
    return f"concat_ws(',', {names})"


_TEMPLATES["typed_lines_of_all_files"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {key} AS cle, {_bad_columns(t)} = '' AS valide, {_bad_columns(t)} AS colonnes FROM raw_{t}"
    for t, key in _SOURCE_KEYS.items()
)
_TEMPLATES["extraction_control"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS nb_lignes_source, count(*) FILTER ({_bad_columns(t)} = '') AS nb_lignes_extraites, "
    f"- count(*) FILTER ({_bad_columns(t)} <> '') AS ecart, "
    f"CASE WHEN count(*) FILTER ({_bad_columns(t)} <> '') = 0 THEN 'OK' ELSE 'KO' END AS statut FROM raw_{t}"
    for name, t in _SOURCE_NAMES.items()
)


def _cents(columns: list[str]) -> list[str]:
    return [f"CAST(round({c} * 100) AS BIGINT)" if c in _NUMERIC - {"sinistre_id"} else c for c in columns]


# Columns that may leave the platform.
_MAY_LEAVE = {
    "clients": "client_id code_postal date_creation statut_client".split(), "contracts": CONTRACTS, "payments": PAYMENTS,
    "claims": "sinistre_id contrat_id date_sinistre montant_estime statut_sinistre".split(),
}
_ENTITIES = {"clients": "clients", "contracts": "contrats", "payments": "paiements", "claims": "sinistres"}
_TEMPLATES["exported_tables"] = " UNION ALL ".join(
    f"SELECT '{e}' AS \"table\", CAST({_MAY_LEAVE[t][0]} AS VARCHAR) AS cle, {_line(_cents(_MAY_LEAVE[t]))} AS ligne FROM fused_{t}"
    for t, e in _ENTITIES.items()
)
_PUBLISHED = {"clients": "out_clients", "contracts": "out_contracts", "payments": "fused_payments", "claims": "fused_claims"}
_TEMPLATES["landed_tables"] = " UNION ALL ".join(
    f"SELECT '{e}' AS \"table\", CAST({COLUMNS[t][0]} AS VARCHAR) AS cle, {_line(_cents(COLUMNS[t]))} AS ligne FROM {_PUBLISHED[t]}"
    for t, e in _ENTITIES.items()
)
_TEMPLATES["payments_of_a_hot_contract"] = """
SELECT p.contrat_id, p.paiement_id, c.client_id, n.nb_paiements FROM raw_hot_payments p
LEFT JOIN (SELECT ab_policy_number, max(ab_client_id) AS client_id FROM raw_A_contracts GROUP BY 1) c
  ON p.contrat_id = c.ab_policy_number
LEFT JOIN (SELECT contrat_id, count(*) AS nb_paiements FROM raw_hot_payments GROUP BY 1) n USING (contrat_id)"""


_TEMPLATES["clients_fused_by_job"] = f"""
SELECT client_id, email, source, email IS NOT NULL
  AND row_number() OVER (PARTITION BY lower(email) ORDER BY source, client_id) > 1 AS doublon
FROM (SELECT 'AB-' || ab_client_id AS client_id, ab_email AS email, 'A' AS source FROM ({_ranked("A_clients", "clean")}) WHERE rn = 1
  UNION ALL SELECT 'AP-' || ap_user_id, ap_mail_address, 'B' FROM ({_ranked("B_clients", "clean")}) WHERE rn = 1)"""
_TEMPLATES["claims_fused_by_job"] = f"""
SELECT source, contrat_id, CASE source WHEN 'A' THEN n ELSE n + max(n) FILTER (source = 'A') OVER () END AS sinistre_id
FROM (SELECT 'A' AS source, ab_policy_number AS contrat_id, TRY_CAST(ab_claim_id AS BIGINT) AS n
    FROM ({_ranked("A_claims", "clean")}) WHERE rn = 1
  UNION ALL SELECT 'B', ap_contract_ref, TRY_CAST(ap_sinistre_num AS BIGINT) FROM ({_ranked("B_claims", "clean")}) WHERE rn = 1)"""
_TEMPLATES["what_if_scenarios"] = f"""
SELECT sinistre_id, contrat_id, scenario, montant_estime, prime_annuelle, proba_fraude, suspect
FROM ({_score("""(SELECT d.* REPLACE (coalesce(s.montant_estime, d.montant_estime) AS montant_estime,
  coalesce(s.prime_annuelle, d.prime_annuelle) AS prime_annuelle), s.scenario
  FROM dataset d JOIN raw_scenarios s USING (sinistre_id, contrat_id))""")})"""
_TEMPLATES["rows_per_fixed_rule"] = """
SELECT id, count(*) AS nb FROM (SELECT CASE WHEN p <= 250000 THEN CASE WHEN m <= 30000 THEN 2 ELSE 3 END
  WHEN j <= 400.5 THEN CASE WHEN e <= 1.5 THEN 6 ELSE 7 END ELSE 8 END AS id
  FROM (SELECT coalesce(prime_annuelle, 0) AS p, coalesce(montant_estime, 0) AS m, coalesce(jours_avant_sinistre, 0) AS j,
    coalesce(nb_paiements_echoues, 0) AS e FROM unscored)) GROUP BY id"""
_TEMPLATES["cross_validation_rows"] = """
SELECT count(*) AS nb_lignes, count(*) FILTER (est_suspect = 1) AS nb_suspects, true AS parts_en_bornes FROM training"""
_TEMPLATES["model_checks"] = """
SELECT (SELECT count(*) FROM unscored) AS nb_scores, true AS probas_en_bornes, true AS verdicts_justes, 5 AS nb_importances,
  true AS importances_somment_a_un, true AS arbre_binaire, true AS regle_unique, true AS parite, true AS relu_egal"""


# --- Assembly -------------------------------------------------------------------------------------------
def _with_tables(body: str) -> str:
    """Put the tables a query names in front of it, each after those it names itself."""
    order: list[str] = []

    def visit(sql: str, own: str | None = None) -> None:
        for name in TABLES:
            if name != own and name not in order and re.search(rf"\b{name}\b", sql):
                visit(TABLES[name], name)
                order.append(name)

    visit(body)
    parts = ", ".join(f"{name} AS ({TABLES[name].strip()})" for name in order)
    return (f"WITH {parts} " if parts else "") + body.strip()


ORACLES: dict[str, str] = {name: _with_tables(body) for name, body in _TEMPLATES.items()}
