"""The whole pipeline on small files: extract, clean, fuse, publish, land, dataset, model, report."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from conftest import rows
from tandem import catalog
from tandem.plans import jobs
from tandem.sources import files, models
from tandem.streaming import landing, topics


def text_schema(columns):
    return T.StructType([T.StructField(c, T.StringType()) for c in columns.split()])


HEADERS = {
    "A_clients": "ab_client_id ab_nom ab_prenom ab_date_naissance ab_email ab_telephone ab_adresse ab_code_postal "
    "ab_num_fiscal ab_date_creation ab_statut_client",
    "B_clients": "ap_user_id ap_full_name ap_birth_date ap_mail_address ap_phone_number ap_street_address "
    "ap_zip_code ap_created_at ap_customer_status ap_loyalty_score",
    "A_contracts": "ab_policy_number ab_client_id ab_type_assurance ab_date_debut ab_date_fin ab_prime_annuelle "
    "ab_statut_contrat ab_agence_id",
    "B_contracts": "ap_contract_ref ap_user_id ap_product_code ap_start_date ap_end_date ap_monthly_premium "
    "ap_contract_state ap_broker_code",
    "A_payments": "ab_payment_id ab_policy_number ab_date_paiement ab_montant ab_mode_paiement",
    "B_payments": "ap_payment_ref ap_contract_ref ap_payment_datetime ap_amount_paid ap_payment_channel "
    "ap_transaction_status",
    "A_claims": "ab_claim_id ab_policy_number ab_date_sinistre ab_montant_estime ab_statut_sinistre ab_description",
    "B_claims": "ap_sinistre_num ap_contract_ref ap_incident_date ap_estimated_amount ap_claim_status "
    "ap_claim_comment ap_fraud_score",
}


def deliver() -> dict[str, list[tuple]]:
    rng = random.Random(3)
    a, b = range(1, 21), range(1, 41)
    out = {
        "A_clients": [(i, f"Nom{i}", "P", "1973-01-27", f"c{i}@voila.fr", "0261177625", "rue", "29617", "FR1",
                       "2024-01-05 13:05:01", "ACTIF") for i in a],
        "B_clients": [(i, f"Nom {i}", "06/10/1943", f"u{i}_at_voila.fr", "+33 4 30 23 51 16", "bd, 3", "73666",
                       "2023-08-07 21:31:33", "ACTIVE", 74) for i in b],  # the last three are clients of both companies
        "A_contracts": [(f"AB-{i}", i, "AUTO", "2024-01-01", "2024-12-31", 1200, "ACTIF", 20) for i in a],
        "B_contracts": [(f"AP-{i}", i, "ASSIST_BASIC", "2024-01-01", "2024-12-31", 100, "TERMINATED", "BRK") for i in b],
        "A_payments": [(i, f"AB-{i}", "2024-02-01", 100.5, "CARTE") for i in a],
        "B_payments": [(f"u{i}", f"AP-{i}", "2024-02-01 08:00:00", 10, "CARD", "FAILED" if i % 2 else "SUCCESS") for i in b],
        "A_claims": [(i, f"AB-{i}", "2024-03-01 05:56:19", 500 + i, "CLOTURE", "Bris") for i in a],
        "B_claims": [(i, f"AP-{i}", "2024-03-01", 9000 if i % 4 == 0 else 500 + rng.random(), "CLOSED", "Panne",
                      95 if i % 4 == 0 else 10) for i in b],
    }
    out["A_clients"].append(out["A_clients"][0])
    for i in (37, 38, 39):
        row = list(out["B_clients"][i])
        row[3] = f" C{i - 30}_at_VOILA.fr"
        out["B_clients"][i] = tuple(row)
    return out


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Paths and controls of a run from files to landed tables."""
    root = tmp_path_factory.mktemp("pipeline")
    at = lambda *parts: str(root.joinpath(*parts))
    controls = {}
    for table, data in deliver().items():
        columns = HEADERS[table].split()
        folder = root / "in" / table
        folder.mkdir(parents=True)
        lines = [",".join(f'"{v}"' for v in r) for r in data]
        (folder / "f.csv").write_text("\n".join([",".join(columns), *lines]) + "\n", encoding="utf-8")
        control = jobs.extract(spark, table, str(folder), text_schema(HEADERS[table]), at("raw", table), at("journal"))
        controls[table] = rows(control)
        source = at("raw", table)
        if table == "A_clients":
            jobs.judge(spark, "AB_CLIENT", source, at("valid"), at("refused"), at("quality"))
            source = at("valid")
        jobs.clean(spark, table, source, at("clean", table))
    tables = {}
    for table, entity in (("clients", "clients"), ("contracts", "contrats"), ("payments", "paiements"),
                          ("claims", "sinistres")):
        control = jobs.fuse_sources(
            spark, table, at("clean", f"A_{table}"), at("clean", f"B_{table}"), at("fused", table), at("fusion")
        )
        controls[table] = rows(control)
        sent = jobs.publish(spark, entity, at("fused", table), "parquet", {"path": at("topic", entity)}, journal=at("sent"))
        stream = topics.message_stream(spark, "parquet", {"path": at("topic", entity)})
        landing.land_topic(stream, entity, at("landed", entity), at("check", entity), None).awaitTermination()
        tables[entity] = landing.read_landed(spark, entity, at("landed", entity))
        assert tables[entity].count() == sent
    return at, controls, tables


def test_counts_agree_at_every_hop(spark, landed):
    at, controls, tables = landed
    assert controls["A_clients"] == [("A_clients", 21, 21, 0, "OK")]
    assert controls["clients"] == [("clients", 20, 40, 57, 3)]
    merged = spark.read.parquet(at("fused", "clients_doublons"))
    assert sorted(r["client_id"] for r in merged.collect()) == ["AP-38", "AP-39", "AP-40"]
    sent = {r["topic"]: (r["tentes"], r["reussis"], r["echoues"]) for r in spark.read.parquet(at("sent")).collect()}
    assert sent["assurance.clients.v1"] == (57, 57, 0) and len(sent) == 4
    assert spark.read.parquet(at("journal")).count() == 8
    assert {e: t.count() for e, t in tables.items()} == {"clients": 57, "contrats": 60, "paiements": 60, "sinistres": 60}


def test_landed_tables_are_harmonised(landed):
    _, _, tables = landed
    client = tables["clients"].filter("client_id = 'AP-7'").first()
    assert (client["email"], client["telephone"], client["statut_client"]) == ("u7@voila.fr", "04 30 23 51 16", "ACTIF")
    assert {r[0] for r in tables["paiements"].select("mode_paiement").distinct().collect()} == {"CARTE"}
    numbers = tables["sinistres"].select("sinistre_id").distinct().count()
    assert numbers == tables["sinistres"].count() == 60
    contract = tables["contrats"].filter("contrat_id = 'AP-7'").first()
    assert (contract["prime_annuelle"], contract["statut_contrat"]) == (1200.0, "RESILIE")


def test_dataset_model_and_report(spark, landed):
    at, _, tables = landed
    counts = jobs.build_dataset(tables["sinistres"], tables["contrats"], tables["paiements"], at("dataset"))
    assert rows(counts) == [(0, None, 20), (1, 0, 30), (1, 1, 10)]
    jobs.train_and_score(spark, at("dataset"), at("model"), at("metrics"), at("predictions"))
    assert rows(files.read_table(spark, at("metrics"))) == [(40, 10, 1.0, 1.0)]
    predictions = files.read_table(spark, at("predictions"))
    assert predictions.columns == ["sinistre_id", "contrat_id", *catalog.FEATURES, "proba_fraude", "suspect"]
    assert predictions.agg({"suspect": "sum"}).first()[0] == 0
    assert models.read_nodes(spark, at("model")).count() == 3
    figures = jobs.key_figures(tables, predictions)
    assert rows(figures["contrats_par_statut"]) == [("ACTIF", 20), ("RESILIE", 40)]
    assert rows(figures["signales"]) == [(0, 20)]
    jobs.export({**tables, "predictions_fraude": predictions}, at("export"), ["predictions_fraude"])
    assert files.read_table(spark, at("export", "clients")).columns == catalog.PUBLIC_COLUMNS["clients"]


def test_written_rules_on_a_source_table(spark, landed):
    at, _, _ = landed
    report = spark.read.parquet(at("quality")).first()
    assert (report["nb_lignes_total"], report["nb_lignes_rejetees"], report["nb_anomalies_avant"]) == (21, 1, 2)
    assert files.read_table(spark, at("valid")).count() == 21
