"""Saved models as a source and a sink."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession

from tandem.operators.trees import leaf_rules, node_table


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node table of the tree inside a saved pipeline."""
    return node_table(spark.read.parquet(f"{path}/stages/*DecisionTreeClassifier*/data"))


def nodes_of(table: DataFrame) -> list[Row]:
    """The nodes on the driver, to build an expression from: 2 ** (depth + 1) - 1 rows at most."""
    return table.collect()


def importances(model: PipelineModel, features: list[str]) -> DataFrame:
    """(feature, importance)."""
    spark = SparkSession.active()
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double")


def rules_text(model: PipelineModel) -> str:
    return model.stages[-1].toDebugString


def rules_table(spark: SparkSession, nodes: list[Row], features: list[str]) -> DataFrame:
    return spark.createDataFrame(leaf_rules(nodes, features), "id int, regle string, proba_fraude double")


def export_model(spark: SparkSession, model_path: str, features: list[str], path: str) -> None:
    """Nodes, importances and rules of a saved model as JSON tables."""
    table, model = read_nodes(spark, model_path), load_model(model_path)
    table.write.mode("overwrite").json(f"{path}/noeuds")
    importances(model, features).write.mode("overwrite").json(f"{path}/importances")
    rules_table(spark, nodes_of(table), features).write.mode("overwrite").json(f"{path}/regles")
