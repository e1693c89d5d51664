"""Mapping, prepared tables and the claim dataset."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tandem import catalog
from tandem.operators.summaries import payments_per_contract
from tandem.plans import dataset, fuse, prepare


@pytest.fixture(scope="module")
def raw_tables(table):
    a = table(
        "ab_client_id string, ab_nom string, ab_prenom string, ab_date_naissance string, ab_email string,"
        "ab_telephone string, ab_adresse string, ab_code_postal string, ab_num_fiscal string,"
        "ab_date_creation string, ab_statut_client string",
        ("1", " Marie ", "Lucie", "27/01/1973", "LUCIE_at_voila.fr", "", "rue C", "29617", "FR9",
         "2024-01-05 13:05:01", "INACTIF"),
        (None, "X", None, "", "", None, None, None, None, "2024-01-05", "ACTIF"),
    )
    b = table(
        "ap_user_id string, ap_full_name string, ap_birth_date string, ap_mail_address string,"
        "ap_phone_number string, ap_street_address string, ap_zip_code string, ap_created_at string,"
        "ap_customer_status string, ap_loyalty_score string",
        ("1", "Eugène Rodriguez", "06/10/1943", "e@gmail.com", "0261177625", "39, bd", "73666",
         "2023-08-07 21:31:33", "ACTIVE", "74"),
    )
    return a, b


def test_clients_of_both_sources_share_one_model(raw_tables):
    fused = fuse.fuse("clients", *raw_tables)
    assert fused.columns == [*catalog.CLIENT_COLUMNS, "source"]
    assert rows(fused) == [
        (None, None, None, None, None, None, None, None, "2024-01-05 00:00:00", "ACTIF", None, "A"),
        ("AB-1", "Marie_Lucie", "1973-01-27", "lucie@voila.fr", None, "rue C", "29617", "FR9",
         "2024-01-05 13:05:01", "INACTIF", None, "A"),
        ("AP-1", "Eugène Rodriguez", "1943-10-06", "e@gmail.com", "0261177625", "39, bd", "73666", None,
         "2023-08-07 21:31:33", "ACTIVE", "74", "B"),
    ]


def test_contracts_payments_and_claims_are_mapped(table):
    contracts = fuse.fuse(
        "contracts",
        table("ab_policy_number string, ab_client_id string, ab_type_assurance string, ab_date_debut string,"
              "ab_date_fin string, ab_prime_annuelle string, ab_statut_contrat string, ab_agence_id string",
              ("AB-000001", "1", "AUTO", "2023-12-16", "2024-12-15", "1808.77", "ACTIF", "20")),
        table("ap_contract_ref string, ap_user_id string, ap_product_code string, ap_start_date string,"
              "ap_end_date string, ap_monthly_premium string, ap_contract_state string, ap_broker_code string",
              ("AP-000001", "1", "AUTO_BASIC", "2024-04-16", "2025-04-16", "154.8", "SUSPENDED", "BRK-431")),
    )
    assert rows(contracts) == [
        ("AB-000001", "AB-1", "AUTO", None, "2023-12-16", "2024-12-15", 1808.77, None, "ACTIF", "20", None, "A"),
        ("AP-000001", "AP-1", None, "AUTO_BASIC", "2024-04-16", "2025-04-16", None, 154.8, "SUSPENDED", None,
         "BRK-431", "B"),
    ]
    claims = fuse.fuse(
        "claims",
        table("ab_claim_id string, ab_policy_number string, ab_date_sinistre string, ab_montant_estime string,"
              "ab_statut_sinistre string, ab_description string",
              ("1", "AB-000006", "2024-11-14 05:56:19", "11987.7", "CLOTURE", "Bris")),
        table("ap_sinistre_num string, ap_contract_ref string, ap_incident_date string,"
              "ap_estimated_amount string, ap_claim_status string, ap_claim_comment string, ap_fraud_score string",
              ("1", "AP-000003", "2026-07-30 16:41:21", "961.39", "CLOSED", "Panne", "94.7")),
    )
    assert rows(claims) == [
        (1, "AB-000006", "2024-11-14 05:56:19", 11987.7, "CLOTURE", "Bris", None, "A"),
        (1, "AP-000003", "2026-07-30", 961.39, "CLOSED", "Panne", "94.7", "B"),
    ]
    payments = fuse.fuse(
        "payments",
        table("ab_payment_id string, ab_policy_number string, ab_date_paiement string, ab_montant string,"
              "ab_mode_paiement string", ("1", "AB-000001", "21/08/2026", "150.73", "CARTE")),
        table("ap_payment_ref string, ap_contract_ref string, ap_payment_datetime string, ap_amount_paid string,"
              "ap_payment_channel string, ap_transaction_status string",
              ("u-1", "AP-000001", "2024-05-01 08:00:00", "x", "CARD", "FAILED")),
    )
    assert rows(payments) == [
        ("1", "AB-000001", "2026-08-21", 150.73, "CARTE", None, "A"),
        ("u-1", "AP-000001", "2024-05-01 08:00:00", None, "CARD", "FAILED", "B"),
    ]


def test_prepared_clients_lose_repeats(table):
    df = table(", ".join(f"{c} string" for c in catalog.CLIENT_COLUMNS),
               *[("1", " A ", *["x"] * 7, "ACTIVE", "3")] * 2, ("2", "B", *[""] * 9))
    got = prepare.prepare_clients(df)
    assert got.columns == ["client_id", "nom_prenom", "date_naissance", "email", "telephone", "statut_client",
                           "date_creation", "loyalty_score"]
    assert rows(got) == [("1", "A", "x", "x", "x", "ACTIF", "x", "3"), ("2", "B", *[None] * 6)]


def test_prepared_contracts(table):
    schema = ", ".join(f"{c} {'double' if c.startswith('prime') else 'string'}" for c in catalog.CONTRACT_COLUMNS)
    df = table(
        schema,
        ("c1", "x", "AUTO", "", "2024-01-01", "2024-12-31", 1200.0, None, "ACTIVE", "", ""),
        ("c1", "x", "AUTO", "", "2024-01-01", "2024-12-31", 1200.0, None, "ACTIVE", "", ""),
        ("c2", "y", " ", "ASSIST_PREMIUM", "2024-01-01 10:00:00", "illisible", 0.0, 100.0, "TERMINATED", "", ""),
    )
    got = {r["contrat_id"]: r for r in prepare.prepare_contracts(df).collect()}
    assert len(got) == 2
    assert (got["c1"]["famille_produit"], got["c1"]["duree_contrat_jours"]) == ("AUTO", 365)
    assert (got["c2"]["famille_produit"], got["c2"]["prime_annuelle_eq"]) == ("ASSISTANCE", 1200.0)
    assert got["c2"]["date_fin"] is None and got["c2"]["duree_contrat_jours"] is None
    assert got["c2"]["statut_contrat"] == "RESILIE"
    assert {r["prime_annuelle_eq"] for r in prepare.prepare_contracts(df, zero_is_missing=False).collect()} == {1200.0, 0.0}


def test_payments_of_each_contract_count_once(table):
    schema = "paiement_id string, contrat_id string, montant double, statut_transaction string"
    paid = [(f"w{k}", "north", 10.0 + k, "SUCCESS" if k % 3 else " failed ") for k in range(7)]
    other = [("w0", "south", 0.07, "ECHOUE"), ("w9", "south", None, None), ("w9", "south", None, None)]
    df = table(schema, *paid, *paid[2:5], *other)
    # A payment number that both contracts use belongs to one of them in the prepared table, to both in the dataset.
    north = sum(cents for _, _, cents, _ in paid[1:])
    assert rows(prepare.prepare_payments(df.filter("contrat_id = 'north'"))) == [("north", 7, north + 10.0, 0)]
    assert rows(payments_per_contract(prepare.tidy_entity(df, "paiements"))) == [("north", 7, 0), ("south", 2, 1)]


def test_claims_of_each_contract_count_once(table):
    schema = "sinistre_id long, contrat_id string, montant_estime double, statut_sinistre string"
    made = [(40 + k, "east" if k < 4 else "west", 0.01 * 3**k, "REJECTED" if k in (1, 5) else "CLOSED") for k in range(6)]
    df = table(schema, *made, made[1], made[1], made[4])
    assert rows(prepare.prepare_claims(df)) == [("east", 4, 0.4, 1), ("west", 2, 3.24, 1)]


CLAIM_SCHEMA = ("sinistre_id long, contrat_id string, date_sinistre string, montant_estime double,"
                "statut_sinistre string, description string, fraud_score string")


def sources(table):
    claims = table(
        CLAIM_SCHEMA,
        (1, "c1", "2024-01-11", 100.0, "REPORTED", "", "80"),
        (1, "c1", "2024-01-11", 100.0, "REPORTED", "", "80"),
        (1, "c2", "2024-01-11", 100.0, "CLOSED", "", ""),
        (2, "c1", "2023-12-31", 100.0, "CLOSED", "", "10"),
        (3, "c1", "2024-02-01", 0.0, "CLOSED", "", "10"),
        (4, "c1", "illisible", 50.0, "CLOSED", "", "10"),
        (5, "c9", "2024-02-01", 50.0, "CLOSED", "", "10"),
        (6, "  ", "2024-02-01", 50.0, "CLOSED", "", "10"),
        (7, "c1", "2024-01-01", None, "CLOSED", "", None),
    )
    contracts = table(
        ", ".join(f"{c} {'double' if c.startswith('prime') else 'string'}" for c in catalog.CONTRACT_COLUMNS),
        ("c1", "x", "AUTO", None, "2024-01-01", "2024-12-31", 1200.0, None, "ACTIF", None, None),
        ("c2", "x", None, "ASSIST_A", "2024-01-01", None, 0.0, 10.0, "ACTIF", None, None),
        ("c2", "y", None, "AUTO_A", "2024-01-02", None, None, None, "ACTIF", None, None),
    )
    payments = table(
        ", ".join(f"{c} {'double' if c == 'montant' else 'string'}" for c in catalog.PAYMENT_COLUMNS),
        ("p1", "c1", "2024-01-01", 5.0, "CARTE", "FAILED"), ("p2", "c1", "2024-01-01", 5.0, "CARTE", None),
        ("p2", "c1", "2024-01-01", 5.0, "CARTE", None),
    )
    return claims, contracts, payments


@pytest.mark.parametrize("at_least", [1, 10**9])
def test_claim_dataset(table, at_least):
    got = dataset.claim_dataset(*sources(table), at_least=at_least, share=0.2, spread=4)
    assert got.columns == catalog.DATASET_COLUMNS
    # A contract number with two clients gives its claim two rows.
    assert rows(got) == [
        (1, "c1", 100.0, "DECLARE", "AUTO", 1200.0, 10, 2, 1, "80"),
        (1, "c2", 100.0, "CLOTURE", "ASSISTANCE", 120.0, 10, 0, 0, None),
        (1, "c2", 100.0, "CLOTURE", "AUTO", None, 9, 0, 0, None),
    ]


def test_discarded_rows_say_why(table):
    features = dataset.claim_features(*sources(table))
    got = {r["sinistre_id"]: r["motif"] for r in dataset.discarded_rows(features).collect()}
    assert got == {2: "jours_avant_sinistre", 3: "montant_estime", 4: "date", 5: "date", 6: "date", 7: "montant_estime"}
    assert features.count() == dataset.coherent_rows(features).count() + dataset.discarded_rows(features).count()


def test_training_and_prediction_sets(table, tmp_path):
    got = dataset.claim_dataset(*sources(table))
    assert rows(dataset.training_rows(got).select("sinistre_id", "est_suspect")) == [(1, 1)]
    assert rows(dataset.training_rows(got, threshold=90).select("est_suspect")) == [(0,)]
    assert rows(dataset.label_counts(dataset.training_rows(got))) == [(1, 1)]
    assert dataset.rows_to_predict(got).count() == 2
    dataset.write_dataset(got, str(tmp_path / "d"))
    back = got.sparkSession.read.parquet(str(tmp_path / "d"))
    assert rows(back.groupBy("note_connue", "est_suspect").agg(F.count("*"))) == [(0, None, 2), (1, 1, 1)]


def test_dataset_reads_only_the_columns_it_needs(table, tmp_path):
    claims, contracts, payments = sources(table)
    paths = {}
    for name, df in (("s", claims), ("c", contracts), ("p", payments)):
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    spark = claims.sparkSession
    plan = dataset.claim_dataset(*(spark.read.parquet(paths[n]) for n in "scp"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split(">")[0] for part in text.split("ReadSchema: ")[1:]]
    assert schemas and not any("description" in s or "mode_paiement" in s or "agence" in s for s in schemas)
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text
