"""Folds, weights, fit, scoring and the compiled tree."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tandem import catalog
from tandem.operators import folds, metrics, trees
from tandem.plans import train
from tandem.sources import models

SCHEMA = "sinistre_id long, contrat_id string, " + ", ".join(f"{c} double" for c in catalog.FEATURES) + ", est_suspect int"


def claims(spark, n=40, noise=0.0, seed=5):
    """Suspect claims have large amounts and early dates; ``noise`` flips some of them."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        suspect = i % 4 == 0
        looks = suspect != (rng.random() < noise)
        amount, days = (9000.0, 5.0) if looks else (500.0, 300.0)
        out.append((i, f"c{i}", amount + rng.random(), 1000.0 + i, days, 3.0, 0.0, int(suspect)))
    return spark.createDataFrame(out, SCHEMA)


def test_class_weights_balance_the_classes(spark):
    got = train.with_label_and_weight(claims(spark))
    assert rows(got.groupBy("label").agg(F.sum("poids"))) == [(0.0, 30.0), (1.0, 30.0)]


def folds_by_hand(ids_and_labels, k, seed):
    out = {}
    for label in {lab for *_, lab in ids_and_labels}:
        group = [(s, c) for s, c, lab in ids_and_labels if lab == label]
        group.sort(key=lambda r: (hashlib.md5(f"{r[0]}|{r[1]}|{seed}".encode()).hexdigest(), r))
        out |= {r: (i + 1) % k for i, r in enumerate(group)}
    return out


@pytest.mark.parametrize("partitions", [1, 9])
def test_folds_equal_one_long_row_count_per_label(spark, partitions):
    rng = random.Random(6)
    data = [(i, f"c{i % 50}", int(rng.random() < 0.3)) for i in range(2000)]
    df = spark.createDataFrame(data, "sinistre_id long, contrat_id string, label int").repartition(partitions)
    got = folds.stratified_folds(df, ["sinistre_id", "contrat_id"], folds=5, seed=42)
    assert {(r["sinistre_id"], r["contrat_id"]): r["pli"] for r in got.collect()} == folds_by_hand(data, 5, 42)
    sizes = [(r["label"], r["nb"]) for r in folds.fold_sizes(got).collect()]
    for label in (0, 1):
        per_fold = [n for lab, n in sizes if lab == label]
        assert len(per_fold) == 5 and max(per_fold) - min(per_fold) <= 1


def test_folds_differ_by_seed(spark):
    df = claims(spark, 200).withColumnRenamed("est_suspect", "label")
    ids = ["sinistre_id", "contrat_id"]
    a, b = (rows(folds.stratified_folds(df, ids, seed=s).select(*ids, "pli")) for s in (1, 2))
    assert a != b


def test_precision_and_recall(table):
    df = table("label double, prediction double", (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (1.0, 1.0))
    assert rows(metrics.precision_recall(df)) == [(5, 3, 2 / 3, 2 / 3)]
    assert rows(metrics.precision_recall(df.filter("label = 0 and prediction = 0"))) == [(1, 0, 0.0, 0.0)]
    assert rows(metrics.precision_recall(df.limit(0))) == [(0, 0, 0.0, 0.0)]


def test_pipeline_has_two_stages_and_a_shallow_weighted_tree():
    assembler, tree = train.model_pipeline().getStages()
    assert assembler.getInputCols() == catalog.FEATURES
    assert (tree.getMaxDepth(), tree.getWeightCol()) == (3, "poids")


def test_separable_claims_are_all_found(spark):
    got = train.cross_validate(train.with_label_and_weight(claims(spark))).first()
    assert (got["precision_suspects"], got["rappel_suspects"], got["nb_lignes"], got["nb_suspects"]) == (1.0, 1.0, 40, 10)


def test_noisy_claims_stay_within_bounds(spark):
    got = train.cross_validate(train.with_label_and_weight(claims(spark, 60, noise=0.4))).first()
    assert 0.0 <= got["precision_suspects"] <= 1.0 and 0.0 <= got["rappel_suspects"] <= 1.0


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_is_refused(spark, label):
    df = train.with_label_and_weight(claims(spark).filter(F.col("est_suspect") == label))
    with pytest.raises(ValueError, match="both classes"):
        train.fit(df)


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "m")
    models.save_model(train.fit(train.with_label_and_weight(claims(spark, 200, noise=0.2))), path)
    return path


def test_compiled_tree_agrees_with_the_model(spark, saved):
    nodes = models.nodes_of(models.read_nodes(spark, saved))
    rng = random.Random(8)
    unknown = spark.createDataFrame(
        [(i, "c", rng.uniform(0, 10000), rng.uniform(900, 1300), rng.uniform(0, 400), 3.0, 1.0, None) for i in range(500)],
        SCHEMA,
    )
    scored = train.predict(models.load_model(saved), unknown)
    both = trees.add_score(scored.withColumnsRenamed({"proba_fraude": "p", "suspect": "s"}), nodes, catalog.FEATURES)
    diff = metrics.largest_difference(both, "p", "proba_fraude").first()
    assert diff["nb_lignes"] == 500 and diff["ecart_max"] < 1e-6 and diff["nb_manquants"] == 0
    assert both.filter("s <> suspect").count() == 0


def test_nodes_importances_and_rules(spark, saved, tmp_path):
    table = models.read_nodes(spark, saved)
    nodes = models.nodes_of(table)
    leaves = [n for n in nodes if n["gauche"] == -1]
    assert all(n["variable"] == -1 and n["seuil"] is None for n in leaves) and len(nodes) == 2 * len(leaves) - 1
    weights = models.importances(models.load_model(saved), catalog.FEATURES)
    assert abs(weights.agg(F.sum("importance")).first()[0] - 1) < 1e-9
    rules = models.rules_table(spark, nodes, catalog.FEATURES).collect()
    data = train.model_input(claims(spark, 200, noise=0.2))
    assert sum(data.filter(r["regle"]).count() for r in rules) == 200
    assert "If (feature" in models.rules_text(models.load_model(saved))
    models.export_model(spark, saved, catalog.FEATURES, str(tmp_path / "x"))
    assert spark.read.json(str(tmp_path / "x" / "noeuds")).count() == len(nodes)


def test_empty_leaf_scores_zero_and_limits_go_left(table):
    nodes = [
        {"id": 0, "stats": [1, 1], "gauche": 1, "droite": 2, "variable": 0, "seuil": 2.5},
        {"id": 1, "stats": [1.0, 3.0], "gauche": -1, "droite": -1, "variable": -1, "seuil": None},
        {"id": 2, "stats": [0.0, 0.0], "gauche": -1, "droite": -1, "variable": -1, "seuil": None},
    ]
    df = trees.add_score(table("a double", (2.5,), (2.6,)), nodes, ["a"])
    assert rows(df) == [(2.5, 0.75, 1), (2.6, 0.0, 0)]


@pytest.mark.parametrize("name", ["model_checks", "tree_parity", "model_predictions"])
def test_one_query_derives_the_claim_dataset_once(spark, monkeypatch, name):
    """Fit, check and prediction read one stored dataset; deriving it is by far the longest step."""
    from tandem.workload import queries

    derived, derive = [], queries.claims_dataset
    monkeypatch.setattr(queries, "claims_dataset", lambda *given: derived.append(given) or derive(*given))
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len(derived) == 1 and "lineitem" not in plan and "Join" not in plan
