"""A fitted tree as a node table, as rules, and as one column expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

Node = Mapping[str, Any]
NO_CHILD = -1


def node_table(stored_nodes: DataFrame) -> DataFrame:
    """Nodes of a saved tree: id, stats, gauche, droite, variable, seuil. A leaf has no children (-1)."""
    inner = F.col("leftChild") != NO_CHILD
    return stored_nodes.select(
        "id",
        F.col("impurityStats").alias("stats"),
        F.col("leftChild").alias("gauche"),
        F.col("rightChild").alias("droite"),
        F.when(inner, F.col("split.featureIndex")).otherwise(NO_CHILD).alias("variable"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("seuil"),
    )


def tree_score(nodes: Sequence[Node], features: Sequence[str]) -> Column:
    """Probability of class 1 as a nested condition, so a table is scored inside generated code.

    Left when the value is at most the threshold; a leaf gives its share of class 1, or 0 when it is empty.
    """
    by_id = {n["id"]: n for n in nodes}

    def walk(node_id: int) -> Column:
        node = by_id[node_id]
        if node["gauche"] == NO_CHILD:
            weight = sum(node["stats"])
            return F.lit(float(node["stats"][1]) / weight if weight > 0 else 0.0)
        left_side = F.col(features[node["variable"]]) <= float(node["seuil"])
        return F.when(left_side, walk(node["gauche"])).otherwise(walk(node["droite"]))

    return walk(0)


def leaf_rules(nodes: Sequence[Node], features: Sequence[str]) -> list[tuple[int, str, float]]:
    """(leaf id, condition in SQL, probability) of each leaf."""
    by_id = {n["id"]: n for n in nodes}
    found: list[tuple[int, str, float]] = []
    pending: list[tuple[int, list[str]]] = [(0, [])]
    while pending:
        node_id, path = pending.pop()
        node = by_id[node_id]
        if node["gauche"] == NO_CHILD:
            weight = sum(node["stats"])
            share = float(node["stats"][1]) / weight if weight > 0 else 0.0
            found.append((node_id, " AND ".join(path) or "true", share))
        else:
            name, limit = features[node["variable"]], node["seuil"]
            pending.append((node["gauche"], [*path, f"{name} <= {limit}"]))
            pending.append((node["droite"], [*path, f"{name} > {limit}"]))
    return sorted(found)


def apply_scenarios(df: DataFrame, scenarios: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Rows under each of their scenarios: a scenario names a row by its ids and gives the features it changes.

    Features that the table lacks or leaves null keep their value; its other columns are added.
    """
    given = [f for f in features if f in scenarios.columns]
    renamed = scenarios.withColumnsRenamed({f: f"_{f}" for f in given})
    joined = df.join(renamed, list(ids))
    changed = {f: F.coalesce(F.col(f"_{f}").cast(dict(df.dtypes)[f]), F.col(f)) for f in given}
    return joined.withColumns(changed).drop(*(f"_{f}" for f in given))


def add_score(df: DataFrame, nodes: Sequence[Node], features: Sequence[str]) -> DataFrame:
    """``proba_fraude`` and the verdict ``suspect``: 1 above one half; a tie goes to 0, as in the model."""
    return df.withColumn("proba_fraude", tree_score(nodes, features)).withColumn(
        "suspect", (F.col("proba_fraude") > 0.5).cast("int")
    )
