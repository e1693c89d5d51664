"""Source tables of both companies, derived from the given tables.

The insurance tables do not exist among the given ones, so each is defined here by one SELECT that Spark and
the checking engine both read. The definitions plant the defects the jobs must handle: blanks, repeats, bad
dates, odd phone and e-mail shapes, unknown words, bad amounts, swapped order of dates, lost keys, and claim
numbers used by both companies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Given tables -> their columns. Stated, so that no footer is read before a job starts.
GIVEN = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _amount(expr: str) -> str:
    return _text(f"CAST({expr} AS DECIMAL(18,2))")


def _turned(day: str) -> str:
    """yyyy-MM-dd text as dd/MM/yyyy."""
    return f"substr({day}, 9, 2) || '/' || substr({day}, 6, 2) || '/' || substr({day}, 1, 4)"


_BIRTH = _text("DATE '1940-01-01' + CAST(c_custkey % 20000 AS INT)")
_CREATED = _text("DATE '2020-01-01' + CAST(c_custkey % 1500 AS INT)")
_HOUR = "lpad(CAST(c_custkey % 24 AS STRING), 2, '0') || ':05:01'"
_PHONE = "lpad(CAST(c_custkey % 10000000 AS STRING), 8, '1')"
# One address in ten is shared by two neighbouring customer numbers.
_PERSON = (
    "CAST(CASE WHEN CAST(FLOOR(c_custkey / 2) AS BIGINT) % 5 = 0 "
    "THEN c_custkey - c_custkey % 2 ELSE c_custkey END AS STRING)"
)
_BIRTH_SHAPES = f"""CASE c_custkey % 20
    WHEN 0 THEN 'inconnue' WHEN 1 THEN {_turned(_BIRTH)} WHEN 2 THEN '31/02/1980' WHEN 3 THEN ''
    WHEN 4 THEN ' ' || {_BIRTH} || chr(9) ELSE {_BIRTH} END"""
_EMAIL_SHAPES = f"""CASE c_custkey % 50
    WHEN 7 THEN '' WHEN 8 THEN 'client' || {_PERSON} || '_at_voila.fr' WHEN 9 THEN 'sans.arobase'
    WHEN 10 THEN '  CLIENT' || {_PERSON} || '@VOILA.FR ' WHEN 11 THEN 'client@sanspoint'
    WHEN 12 THEN chr(9) || 'client' || {_PERSON} || '@voila.fr' || chr(10)
    ELSE 'client' || {_PERSON} || '@voila.fr' END"""
_PHONE_SHAPES = f"""CASE WHEN c_custkey % 25 = 0 THEN ' ' ELSE CASE c_custkey % 6
    WHEN 0 THEN '+33 (0)6 ' || {_PHONE} WHEN 1 THEN '+33 4 ' || {_PHONE} WHEN 2 THEN '0033 6' || {_PHONE}
    WHEN 3 THEN '02.' || substr({_PHONE}, 1, 2) || '.' || substr({_PHONE}, 3, 6)
    WHEN 4 THEN '05' || {_PHONE} ELSE '12345' END END"""
_CREATED_SHAPES = f"""CASE WHEN c_custkey % 401 = 0 THEN 'hier' WHEN c_custkey % 33 = 0 THEN {_turned(_CREATED)}
    WHEN c_custkey % 34 = 0 THEN {_CREATED} ELSE {_CREATED} || ' ' || {_HOUR} END"""
_POSTCODE = """CASE WHEN c_custkey % 40 = 0 THEN '123' WHEN c_custkey % 41 = 0 THEN 'A1234'
    ELSE lpad(CAST(c_nationkey * 1000 + c_custkey % 1000 AS STRING), 5, '0') END"""
_CUSTOMERS = "(SELECT * FROM {customer} UNION ALL SELECT * FROM {customer} WHERE c_custkey % 97 = 0) c"

_START = _text("CAST(o_orderdate AS DATE)")
_END = _text("CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 83 = 0 THEN -10 ELSE 365 END AS INT)")
_MONTHLY = _amount("FLOOR(o_totalprice * 100 / 12) / 100")
_CLIENT_OF = "CAST(o_custkey + second_client AS STRING)"
# Every 89th contract is delivered twice, every 157th names a second client.
_ORDERS = """(SELECT *, 0 AS second_client FROM {orders}
    UNION ALL SELECT *, 0 AS second_client FROM {orders} WHERE o_orderkey % 89 = 0
    UNION ALL SELECT *, 1 AS second_client FROM {orders} WHERE o_orderkey % 157 = 0) o"""

_SHIPPED = _text("CAST(l_shipdate AS DATE)")
_INCIDENT = _text("CAST(l_shipdate AS DATE) - CAST(CASE WHEN l_suppkey % 5 = 0 THEN 200 ELSE 0 END AS INT)")
_CLAIM_AMOUNT = f"""CASE WHEN l_quantity <= 2 THEN '0' WHEN l_orderkey % 71 = 0 THEN 'nc'
    ELSE {_amount("l_extendedprice")} END"""
_LINE_ID = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"


def _contract_ref(prefix: str, every: int) -> str:
    return f"CASE WHEN l_orderkey % {every} = 0 THEN ' ' ELSE '{prefix}' || CAST(l_orderkey AS STRING) END"


#: Table -> SELECT over the given tables, with the columns as delivered by the source.
RAW = {
    "A_clients": f"""
SELECT CAST(c_custkey AS STRING) AS ab_client_id,
  CASE WHEN c_custkey % 211 = 5 THEN '  ' ELSE '  Nom' || CAST(c_nationkey AS STRING) || ' ' END AS ab_nom,
  c_name AS ab_prenom, {_BIRTH_SHAPES} AS ab_date_naissance, {_EMAIL_SHAPES} AS ab_email,
  {_PHONE_SHAPES} AS ab_telephone,
  CASE WHEN c_custkey % 17 = 0 THEN '   ' ELSE 'rue ' || CAST(c_nationkey AS STRING) END AS ab_adresse,
  {_POSTCODE} AS ab_code_postal,
  CASE WHEN c_custkey % 301 = 1 THEN '' ELSE 'FR' || CAST(c_custkey AS STRING) END AS ab_num_fiscal,
  {_CREATED_SHAPES} AS ab_date_creation,
  CASE c_mktsegment WHEN 'FURNITURE' THEN 'ACTIF' WHEN 'MACHINERY' THEN ' INACTIF ' WHEN 'HOUSEHOLD' THEN 'SUSPENDU'
    WHEN 'AUTOMOBILE' THEN '' ELSE 'Prospect' END AS ab_statut_client
FROM {_CUSTOMERS} WHERE c_custkey % 3 <> 0""",
    "B_clients": f"""
SELECT CAST(c_custkey AS STRING) AS ap_user_id, CASE WHEN c_custkey % 207 = 0 THEN '' ELSE c_name || ' ' END AS ap_full_name,
  {_BIRTH_SHAPES} AS ap_birth_date, {_EMAIL_SHAPES} AS ap_mail_address, {_PHONE_SHAPES} AS ap_phone_number,
  CASE WHEN c_custkey % 18 = 0 THEN '' ELSE CAST(c_nationkey AS STRING) || ', boulevard' END AS ap_street_address,
  {_POSTCODE} AS ap_zip_code, {_CREATED_SHAPES} AS ap_created_at,
  CASE c_mktsegment WHEN 'FURNITURE' THEN 'ACTIVE' WHEN 'MACHINERY' THEN 'Inactive ' WHEN 'HOUSEHOLD' THEN 'SUSPENDED'
    WHEN 'AUTOMOBILE' THEN ' ' ELSE 'Lead' END AS ap_customer_status,
  CASE WHEN c_custkey % 12 = 0 THEN '' ELSE CAST(c_custkey % 101 AS STRING) END AS ap_loyalty_score
FROM {_CUSTOMERS} WHERE c_custkey % 3 = 0""",
    "A_contracts": f"""
SELECT 'AB-' || CAST(o_orderkey AS STRING) AS ab_policy_number, {_CLIENT_OF} AS ab_client_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'AUTO' WHEN '2-HIGH' THEN 'HABITATION' WHEN '3-MEDIUM' THEN 'SANTE'
    WHEN '4-NOT SPECIFIED' THEN 'ASSIST' ELSE '' END AS ab_type_assurance,
  {_START} AS ab_date_debut, {_END} AS ab_date_fin,
  CASE WHEN o_orderkey % 59 = 0 THEN '' WHEN o_orderkey % 67 = 0 THEN '-1' ELSE {_amount("o_totalprice")} END
    AS ab_prime_annuelle,
  CASE o_orderstatus WHEN 'O' THEN 'ACTIF' WHEN 'F' THEN 'RESILIE' ELSE 'SUSPENDU' END AS ab_statut_contrat,
  CAST(o_orderkey % 40 AS STRING) AS ab_agence_id
FROM {_ORDERS} WHERE o_orderkey % 3 <> 0""",
    "B_contracts": f"""
SELECT 'AP-' || CAST(o_orderkey AS STRING) AS ap_contract_ref, {_CLIENT_OF} AS ap_user_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'AUTO_BASIC' WHEN '2-HIGH' THEN 'HABITATION_PLUS_2'
    WHEN '3-MEDIUM' THEN 'ASSIST_PREMIUM' WHEN '4-NOT SPECIFIED' THEN 'SANTE' ELSE ' ' END AS ap_product_code,
  {_START} AS ap_start_date, {_END} || ' 00:00:00' AS ap_end_date,
  CASE WHEN o_orderkey % 61 = 0 THEN '' WHEN o_orderkey % 73 = 0 THEN 'n/a' ELSE {_MONTHLY} END AS ap_monthly_premium,
  CASE WHEN o_orderstatus = 'O' AND o_orderkey % 7 = 0 THEN ' active' WHEN o_orderstatus = 'O' THEN 'ACTIVE'
    WHEN o_orderstatus = 'F' AND o_orderkey % 11 = 0 THEN 'Archived' WHEN o_orderstatus = 'F' THEN 'TERMINATED'
    WHEN o_orderkey % 13 = 0 THEN '' ELSE 'SUSPENDED' END AS ap_contract_state,
  'BRK-' || CAST(o_orderkey % 900 AS STRING) AS ap_broker_code
FROM {_ORDERS} WHERE o_orderkey % 3 = 0""",
    "A_payments": f"""
SELECT {_LINE_ID} AS ab_payment_id, {_contract_ref("AB-", 977)} AS ab_policy_number,
  CASE WHEN l_suppkey % 19 = 0 THEN {_turned(_SHIPPED)} ELSE {_SHIPPED} END AS ab_date_paiement,
  {_amount("l_extendedprice")} AS ab_montant,
  CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN 'PRELEVEMENT' WHEN 1 THEN 'CARTE' WHEN 2 THEN 'VIREMENT'
    WHEN 3 THEN 'CHEQUE' ELSE '' END AS ab_mode_paiement
FROM {{lineitem}} WHERE l_orderkey % 3 <> 0""",
    "B_payments": f"""
SELECT {_LINE_ID} AS ap_payment_ref, {_contract_ref("AP-", 981)} AS ap_contract_ref,
  CASE WHEN l_suppkey % 23 = 0 THEN 'jamais' ELSE {_SHIPPED} || ' 08:30:00' END AS ap_payment_datetime,
  {_amount("l_extendedprice")} AS ap_amount_paid,
  CASE CAST(l_quantity AS INT) % 4 WHEN 0 THEN 'CARD' WHEN 1 THEN 'BANK_TRANSFER' WHEN 2 THEN 'DIRECT_DEBIT'
    ELSE 'CASH' END AS ap_payment_channel,
  CASE l_returnflag WHEN 'R' THEN 'FAILED' WHEN 'A' THEN 'PENDING' ELSE 'SUCCESS' END AS ap_transaction_status
FROM {{lineitem}} WHERE l_orderkey % 3 = 0""",
    "A_claims": f"""
SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS ab_claim_id, {_contract_ref("AB-", 499)} AS ab_policy_number,
  CASE WHEN l_suppkey % 29 = 0 THEN '' ELSE {_INCIDENT} || ' 05:56:19' END AS ab_date_sinistre,
  {_CLAIM_AMOUNT} AS ab_montant_estime,
  CASE WHEN l_linestatus = 'O' AND l_quantity < 25 THEN 'DECLARE' WHEN l_linestatus = 'O' THEN 'EN_COURS'
    WHEN l_quantity < 25 THEN 'CLOTURE' ELSE 'REJETE' END AS ab_statut_sinistre,
  CASE WHEN l_linenumber = 3 THEN '' ELSE 'Dossier "' || CAST(l_suppkey AS STRING) || '"; suite' END AS ab_description
FROM {{lineitem}} WHERE l_returnflag = 'R' AND l_orderkey % 3 <> 0""",
    "B_claims": f"""
SELECT CAST((l_orderkey + 1) * 10 + l_linenumber AS STRING) AS ap_sinistre_num,
  {_contract_ref("AP-", 501)} AS ap_contract_ref, {_INCIDENT} AS ap_incident_date,
  {_CLAIM_AMOUNT} AS ap_estimated_amount,
  CASE WHEN l_linestatus = 'O' AND l_quantity < 25 THEN 'REPORTED' WHEN l_linestatus = 'O' THEN 'IN_PROGRESS'
    WHEN l_quantity < 25 THEN 'CLOSED' WHEN l_quantity = 50 THEN 'LOST' ELSE 'REJECTED' END AS ap_claim_status,
  'Dossier ' || CAST(l_suppkey AS STRING) AS ap_claim_comment,
  CASE WHEN l_suppkey % 37 = 0 THEN '' WHEN l_suppkey % 41 = 0 THEN 'haut'
    ELSE {_text("CAST(l_quantity * 2 AS INT)")} END AS ap_fraud_score
FROM {{lineitem}} WHERE l_returnflag = 'R' AND l_orderkey % 3 = 0""",
    # Payment messages as they come off a topic; some are broken, some carry a word for the amount.
    "messages": """
SELECT CAST(event_id AS STRING) AS key,
  '{{"paiement_id":"' || CAST(event_id AS STRING) || '","contrat_id":"AB-' || CAST(user_id AS STRING)
  || '","date_paiement":"' || substr(CAST(ts AS STRING), 1, 19) || '","montant":'
  || CASE WHEN event_id % 50 = 7 THEN '' WHEN event_id % 70 = 9 THEN '"beaucoup"'
       ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END
  || ',"mode_paiement":' || CASE WHEN event_type = 'view' THEN 'null' ELSE '"' || event_type || '"' END
  || ',"statut_transaction":"SUCCESS"}}' AS value
FROM {events}""",
    # Durations of pipeline steps.
    "timings": "SELECT event_id, ts AS date, event_type AS etape, value AS duree_s FROM {events}",
    # Lines of the status log.
    "status_lines": """
SELECT substr(CAST(ts AS STRING), 1, 19) || ' | ' || CASE WHEN event_type = 'error' THEN 'ALERTE' ELSE 'OK' END
  || ' | ' || CASE user_id % 4 WHEN 0 THEN 'Kafka' WHEN 1 THEN 'Hadoop' WHEN 2 THEN 'Streaming' ELSE 'Spark' END
  || ' | mesure ' || CAST(event_id AS STRING) || ' | ' || event_type AS value
FROM {events}""",
}


# Cases planted beside the source tables, each for one rule of an operator.
RAW |= {
    # Amounts that are no numbers to add up, and one too large for most columns of cents.
    "odd_amounts": """
SELECT l_orderkey AS id, CASE l_linenumber WHEN 1 THEN 'NaN' WHEN 2 THEN '-Infinity' WHEN 3 THEN '1e400'
  WHEN 4 THEN CAST(l_orderkey AS STRING) || '0000000000000000' ELSE CAST(l_orderkey AS STRING) || '.25' END AS montant
FROM {lineitem}""",
    # Durations with gaps, some of them the last of their step.
    "timing_gaps": """
SELECT event_id, ts AS date, event_type AS etape,
  CASE WHEN event_id % 3 = 0 OR event_type = 'error' AND event_id > 5 THEN NULL ELSE value END AS duree_s
FROM {events}""",
    # Claims whose description runs over two lines.
    "long_claims": """
SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS ab_claim_id, 'AB-' || CAST(l_orderkey AS STRING) AS ab_policy_number,
  'Dossier "' || CAST(l_suppkey AS STRING) || '";' || CASE WHEN l_linenumber = 2 THEN chr(13) || chr(10) ELSE chr(10) END
  || 'suite' AS ab_description
FROM {lineitem} WHERE l_returnflag = 'R'""",
    # Clients of three companies, one of which no list names; some numbers are foreign or short, some addresses wrong.
    "three_companies": """
SELECT CAST(c_custkey AS STRING) AS client_id, CASE c_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'B' END AS source,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Client' || CAST(CAST(FLOOR(c_custkey / 4) AS BIGINT) AS STRING) || '@voila.fr' END AS email
FROM {customer}""",
    # Scenarios for single claims: another amount, another premium.
    "scenarios": """
SELECT l_orderkey * 10 + l_linenumber AS sinistre_id, 'AB-' || CAST(l_orderkey AS STRING) AS contrat_id,
  'essai ' || CAST(l_linenumber AS STRING) AS scenario, CASE WHEN l_linenumber = 1 THEN l_extendedprice * 2 END AS montant_estime,
  CASE WHEN l_linenumber = 2 THEN 250000.5 END AS prime_annuelle
FROM {lineitem} WHERE l_returnflag = 'R' AND l_linenumber < 4""",
    # Payments of which four in seven are for one contract, and some for none.
    "hot_payments": """
SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS paiement_id,
  CASE WHEN l_linenumber < 4 THEN 'AB-1' WHEN l_linenumber = 7 THEN NULL ELSE 'AB-' || CAST(l_orderkey AS STRING) END AS contrat_id
FROM {lineitem}""",
}
_ODD_PHONES = """CASE WHEN c_custkey % 31 = 0 THEN '+32 2 555 12 ' || CAST(c_custkey % 90 + 10 AS STRING)
    WHEN c_custkey % 37 = 0 THEN '06 11' WHEN c_custkey % 43 = 0 THEN 'poste 4' ELSE """
for _name in ("A_clients", "B_clients"):
    RAW[_name] = RAW[_name].replace(_PHONE_SHAPES, f"{_ODD_PHONES}{_PHONE_SHAPES} END")


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A derived source table, as a Spark plan over the given Parquet tables it names."""
    used = {
        name: spark.read.schema(columns).parquet(f"{sf_dir}/{name}.parquet")
        for name, columns in GIVEN.items()
        if f"{{{name}}}" in RAW[table]
    }
    return spark.sql(RAW[table], **used)


def raw_sql(table: str) -> str:
    """The same table as SQL over views named like the given tables."""
    return RAW[table].format(**{g: g for g in GIVEN}).strip()
