"""Quality rules, reports, controls and monitoring."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tandem import catalog
from tandem.operators import monitor, quality, reconcile, reports, summaries
from tandem.operators.quality import CORRECT, FLAG, REJECT, Rule

RULES = [
    Rule("nom", "empty", REJECT),
    Rule("ne", "bad_date", REJECT),
    Rule("ne", "date_form", CORRECT, False),
    Rule("mail", "empty", CORRECT),
    Rule("mail", "misspelt_email", CORRECT),
    Rule("mail", "bad_email", FLAG),
    Rule("cp", "bad_postcode", FLAG),
    Rule("fin", "ends_before", FLAG, "ne"),
    Rule("prime", "bad_amount", REJECT),
    Rule("statut", "other_word", FLAG, ["ACTIF"]),
]
SCHEMA = "id string, nom string, ne string, mail string, cp string, fin string, prime string, statut string"
GOOD = ("1", "A", "2000-01-01", "a@b.fr", "29617", "2001-01-01", "10", "ACTIF")


def with_(**changes):
    names = SCHEMA.replace(" string", "").split(", ")
    return tuple(changes.get(n, v) for n, v in zip(names, GOOD))


@pytest.mark.parametrize(
    "changes, reject, correct, flag",
    [
        ({}, [], [], []),
        ({"nom": " "}, ["nom:empty"], [], []),
        ({"ne": "01/02/2000"}, [], ["ne:date_form"], []),
        ({"ne": "31/02/2000"}, ["ne:bad_date"], [], []),
        ({"mail": ""}, [], ["mail:empty"], []),
        ({"mail": "a_at_b.fr"}, [], ["mail:misspelt_email"], []),
        ({"mail": "ab.fr"}, [], [], ["mail:bad_email"]),
        ({"cp": "2961"}, [], [], ["cp:bad_postcode"]),
        ({"cp": None}, [], [], ["cp:bad_postcode"]),
        ({"fin": "1999-12-31"}, [], [], ["fin:ends_before"]),
        ({"prime": "-1"}, ["prime:bad_amount"], [], []),
        ({"prime": "abc"}, ["prime:bad_amount"], [], []),
        ({"prime": None}, ["prime:bad_amount"], [], []),
        ({"statut": "Lead"}, [], [], ["statut:other_word"]),
        ({"statut": None}, [], [], ["statut:other_word"]),
    ],
)
def test_each_rule(table, changes, reject, correct, flag):
    got = quality.check_rows(table(SCHEMA, with_(**changes)), RULES).first()
    assert [got[s].split(",") if got[s] else [] for s in (REJECT, CORRECT, FLAG)] == [reject, correct, flag]


def test_split_and_correction(table):
    df = table(SCHEMA, GOOD, with_(id="2", nom=""), with_(id="3", mail=" ", ne="01/02/2000"),
               with_(id="4", mail="a_at_b.fr"))
    valid, rejected = quality.split_rejected(quality.check_rows(df, RULES))
    assert [r["id"] for r in rejected.collect()] == ["2"]
    fixed = quality.correct_rows(valid, RULES, catalog.PLACEHOLDER)
    assert rows(fixed.select("id", "ne", "mail")) == [
        ("1", "2000-01-01", "a@b.fr"), ("3", "2000-02-01", "NON_RENSEIGNE"), ("4", "2000-01-01", "a@b.fr"),
    ]
    assert rows(quality.correct_rows(valid, RULES).select("mail").filter("mail is null")) == [(None,)]


def test_report_counts_repeats_as_rejected(table):
    df = table(SCHEMA, GOOD, GOOD, with_(id="2", nom=""), with_(id="3", mail=" "), with_(id="4", cp="1"))
    got = quality.quality_report(df, "T", "id", RULES)
    assert rows(got) == [("T", 5, 5, 100.0, 2, 1, 20.0)]
    one_pair = quality.quality_report(table(SCHEMA, GOOD, GOOD, with_(id="5")), "T", "id", RULES)
    assert rows(one_pair) == [("T", 3, 2, 66.67, 1, 0, 0.0)]
    empty = quality.quality_report(df.limit(0), "T", "id", RULES)
    assert rows(empty) == [("T", 0, 0, None, 0, 0, None)]


def test_rule_counts(table):
    df = table(SCHEMA, GOOD, with_(nom="", cp=""), with_(cp=""))
    assert rows(quality.rule_counts(df, RULES)) == [("cp:bad_postcode", 2), ("nom:empty", 1)]


def test_every_source_table_has_its_rules():
    assert set(quality.SOURCE_RULES) == {
        "AB_CLIENT", "AB_CONTRAT", "AB_SINISTRE", "AB_PAIEMENT", "AP_USERS", "AP_CONTRACTS", "AP_CLAIMS", "AP_PAYMENTS",
    }
    for _, rules in quality.SOURCE_RULES.values():
        assert all(r.check in quality.CHECKS and r.severity in (REJECT, CORRECT, FLAG) for r in rules)
        assert all(r.check in quality.FIXES for r in rules if r.severity == CORRECT)


def test_swapped_columns_are_incoherent(table):
    df = table("client_id string, statut_client string, date_creation string",
               ("AB-1", " actif", "2024-01-05 13:05:01"), ("AP-1", "2023-08-07 21:31:33", "ACTIVE"),
               ("AP-2", "ACTIF", "05/01/2024"), ("AP-3", None, "2024-01-05"))
    got = quality.incoherent_rows(df, "statut_client", "date_creation", ["ACTIF", "ACTIVE"])
    assert [r["client_id"] for r in got.orderBy("client_id").collect()] == ["AP-1", "AP-2", "AP-3"]


# --- Controls -------------------------------------------------------------------------------------------
def test_extraction_control(table):
    three, two = table("i int", (1,), (2,), (3,)), table("i int", (1,), (2,))
    got = reconcile.extraction_control({"A": three, "B": two, "C": two}, {"A": two, "B": two})
    assert rows(got) == [("A", 3, 2, -1, "KO"), ("B", 2, 2, 0, "OK"), ("C", 2, 0, -2, "KO")]


def test_fusion_control_counts_real_final_rows(table):
    a, b = table("i int", (1,), (2,)), table("i int", (2,), (3,))
    got = reconcile.fusion_control({"clients": a}, {"clients": b}, {"clients": a.union(b).distinct()})
    assert rows(got) == [("clients", 2, 2, 3, 1)]


def test_duplicate_counts_ignore_case(table):
    df = table("k string", ("a",), ("A",), ("b",), (None,), (None,))
    assert rows(reconcile.duplicate_counts(df, "k")) == [(3, 2)]
    assert rows(reconcile.duplicate_counts(df.limit(0), "k")) == [(0, 0)]


def test_publish_control(table):
    got = reconcile.publish_control({"t1": 3, "t2": 1}, {"t1": table("k int", (1,), (2,))})
    assert rows(got) == [("t1", 3, 2, 1), ("t2", 1, 0, 1)]


# --- Reports --------------------------------------------------------------------------------------------
def test_key_figures(table):
    contracts = table("contrat_id string, statut_contrat string, type_assurance string",
                      ("c1", "ACTIF", "AUTO"), ("c2", "ACTIF", None), ("c3", None, "AUTO"))
    counts = summaries.count_by(contracts, {"statut_contrat": catalog.EMPTY_LABEL})
    assert [tuple(r) for r in summaries.most_frequent_first(counts, ["statut_contrat"]).collect()] == [
        ("ACTIF", 2), ("(vide)", 1),
    ]
    by_type = reports.with_status(contracts, "statut_contrat", "(vide)", catalog.EMPTY_LABEL)
    assert rows(summaries.count_by(by_type, {"type_assurance": catalog.UNKNOWN_LABEL})) == [("AUTO", 1)]
    claims = table("montant_estime string", ("17.01",), ("9983.98",), ("sans objet",), (None,), ("12345678901234567.5",), ("NaN",))
    assert rows(summaries.total_amount(claims, "montant_estime", "t")) == [(12345678901244568.0,)]
    assert rows(summaries.total_amount(claims.limit(0), "montant_estime", "t")) == [(0.0,)]
    assert rows(summaries.count_tables({"a": contracts, "b": claims})) == [("a", 3), ("b", 6)]


def test_thresholds(table):
    df = table("sinistre_id int, contrat_id string, proba_fraude double", (1, "a", 0.9), (2, "b", 0.1), (3, "c", 0.5), (4, "d", None))
    assert [r["sinistre_id"] for r in reports.to_watch(df, 0.5).collect()] == [1, 3]
    assert rows(reports.flagged_share(df, 0.1)) == [(3, 4)]
    assert reports.as_percent(df).columns == ["sinistre_id", "contrat_id", "proba_fraude (%)"]
    assert [r[2] for r in reports.as_percent(df).orderBy("sinistre_id").collect()] == [90, 10, 50, None]


def test_allow_list_keeps_new_columns_in(table):
    df = table("client_id string, email string, code_postal string", ("1", "a@b", "29617"))
    assert reports.only_columns(df, catalog.PUBLIC_COLUMNS["clients"]).columns == ["client_id", "code_postal"]
    assert [r["client_id"] for r in reports.first_rows(df.union(df), ["client_id"], 1).collect()] == ["1"]


# --- Monitoring -----------------------------------------------------------------------------------------
#: Border cases of our own: exactly factor x mean, just above it, at and above the least duration, few measures, gaps.
HABITS = {
    "exactly_three_times": ([0.8, 1.2, 1.0, 3.0], 3, False),
    "just_above_three_times": ([0.8, 1.2, 1.0, 3.00001], 3, True),
    "exactly_a_second": ([0.01, 0.02, 0.03, 0.02, 1.0], 2, False),
    "above_a_second": ([0.01, 0.02, 0.03, 0.02, 1.25], 2, True),
    "too_few": ([0.4, 0.4, 90.0], 2, False),
    "faster": ([70.0, 35.0, 35.0, 2.5, 1.5], 2, False),
    "gap_before_the_last": ([1.0, None, 2.0, None, 4.0, 8.0], 3, True),
    "gap_at_the_end": ([1.5, 2.5, 0.5, 6.75, None], 4, True),
    "only_gaps": ([None, None, None, None, None], 2, False),
}


@pytest.mark.parametrize("case", HABITS)
def test_slow_down(table, case):
    seconds, factor, slow = HABITS[case]
    df = table("date int, etape string, duree_s double", *[(i, case, x) for i, x in enumerate(seconds)])
    got = monitor.slow_steps(df.repartition(3), factor=factor).first()
    known = [x for x in seconds if x is not None]
    assert (got["ralenti"], got["nb_mesures"]) == (slow, len(known))
    enough = len(known) >= 4
    assert got["derniere_s"] == (known[-1] if enough else None)
    mean = sum(known[:-1]) / len(known[:-1]) if enough else None
    assert got["moyenne_avant_s"] == (None if mean is None else pytest.approx(mean))


def test_last_of_several_measures_at_one_time(table):
    df = table("date int, n int, etape string, duree_s double", *[(1, i, "s", float(i)) for i in (3, 9, 1, 2)])
    got = monitor.slow_steps(df, ["date", "n"]).first()
    assert (got["derniere_s"], got["ralenti"]) == (9.0, True)


def test_durations_and_history(table):
    df = table("date int, etape string, duree_s double", (2, "s", 1.239), (1, "s", 2.0), (3, "t", 1.0))
    assert rows(monitor.step_durations(df)) == [("s", 2, 1.24, 1.62, 2.0), ("t", 1, 1.0, 1.0, 1.0)]
    assert [r["date"] for r in monitor.step_history(df, "s").collect()] == [1, 2]
    assert [r["etape"] for r in monitor.step_names(df).collect()] == ["s", "t"]


def test_status_log(table):
    log = monitor.parse_status_log(table(
        "value string", ("2026-10-06 13:14:04 | OK | Kafka | Kafka répond",),
        ("2026-10-06 13:15:04 | ALERTE | Hadoop | 1 | sur 2",), ("tronqué",),
    ))
    assert rows(monitor.status_counts(log)) == [(None, None, 1), ("Hadoop", "ALERTE", 1), ("Kafka", "OK", 1)]
    newest = monitor.newest_lines(log, 1).first()
    assert (newest["service"], newest["message"]) == ("Hadoop", "1 | sur 2")


def test_checks(table):
    full, empty = table("i int", (1,)), table("i int")
    checks = monitor.landed_checks({"clients": full, "contrats": empty})
    assert rows(checks) == [("clients", 1, True), ("contrats", 0, False)]
    assert rows(monitor.failed_checks(checks)) == [(1, "contrats")]
    df = table("a string, b int", (None, None), ("x", None), (None, 1))
    assert monitor.empty_rows(df).count() == 1
    assert monitor.empty_rows(df, ignore=["b"]).count() == 2


@pytest.mark.parametrize("part", [0, 1])
def test_rows_are_split_by_their_verdicts_not_by_rules_made_anew(spark, part):
    """Each form is made once per row: the filter reads the verdict, and no form is copied into it."""
    key, rules = quality.SOURCE_RULES["AB_PAIEMENT"]
    columns = [key, *sorted({r.column for r in rules})]
    rows = spark.range(10).select(*(F.col("id").cast("string").alias(c) for c in columns))
    plan = quality.split_rejected(quality.check_rows(rows, rules))[part]._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "trim(" in line]
    assert plan.count("as timestamp_ntz)") == 1


def test_rejecting_rules_are_judged_before_the_forms_of_other_rules(spark):
    """The filter on the verdict that rejects stands before the forms that only corrections and flags read."""
    key, rules = quality.SOURCE_RULES["AB_CLIENT"]
    columns = [key, *sorted({r.column for r in rules})]
    data = spark.range(10).select(*(F.col("id").cast("string").alias(c) for c in columns))
    for part in quality.split_rejected(quality.check_rows(data, rules)):
        plan = part._jdf.queryExecution().optimizedPlan().toString().splitlines()
        verdict = next(i for i, line in enumerate(plan) if "Filter" in line and REJECT in line)
        phones = [i for i, line in enumerate(plan) if "AS _phone_" in line or "_phone_ab_telephone, " in line]
        assert phones and max(phones) < verdict
