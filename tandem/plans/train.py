"""Train, cross-validate and apply the weighted decision tree."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tandem import catalog
from tandem.operators.clean import features_as_double
from tandem.operators.folds import class_weights, stratified_folds
from tandem.operators.metrics import precision_recall
from tandem.session import store


def model_pipeline(features: Sequence[str] = catalog.FEATURES, depth: int = catalog.TREE_DEPTH) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="poids", maxDepth=depth),
        ]
    )


def model_input(df: DataFrame, features: Sequence[str] = catalog.FEATURES) -> DataFrame:
    return features_as_double(df, features)


def with_label_and_weight(training: DataFrame) -> DataFrame:
    return class_weights(model_input(training).withColumn("label", F.col("est_suspect").cast("double")))


def require_both_classes(training: DataFrame, label: str = "label") -> None:
    """A tree needs suspects and non-suspects; one count per class decides."""
    classes = training.agg(
        F.count_if(F.col(label) == 1).alias("suspects"), F.count_if(F.col(label) != 1).alias("others")
    ).first()
    if not classes["suspects"] or not classes["others"]:
        raise ValueError(
            f"training needs claims of both classes: {classes['suspects']} suspect, {classes['others']} other"
        )


def fit(training: DataFrame) -> PipelineModel:
    """Tree fitted on all rows; ``training`` holds features, label and weight."""
    require_both_classes(training)
    return model_pipeline().fit(training)


def out_of_fold_predictions(
    training: DataFrame, ids: Sequence[str] = ("sinistre_id", "contrat_id"), folds: int = catalog.FOLDS
) -> DataFrame:
    """Each row predicted by a tree that has not seen its fold.

    The folds are stored once, a folder each, since every fit reads them several times and each test one of them.
    """
    require_both_classes(training)
    dealt = store(stratified_folds(training, ids, folds=folds), "folds", by="pli")
    parts = [
        model_pipeline().fit(dealt.filter(F.col("pli") != k)).transform(dealt.filter(F.col("pli") == k))
        for k in range(folds)
    ]
    return reduce(DataFrame.unionByName, parts).select(*ids, "label", "pli", "prediction")


def cross_validate(training: DataFrame, ids: Sequence[str] = ("sinistre_id", "contrat_id")) -> DataFrame:
    """One row of pooled metrics: rows, suspects, precision and recall of the suspects."""
    return precision_recall(out_of_fold_predictions(training, ids))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Probability of the suspect class and the verdict, beside the ids and features."""
    scored = model.transform(model_input(rows))
    return scored.select(
        "sinistre_id",
        "contrat_id",
        *catalog.FEATURES,
        vector_to_array("probability")[1].alias("proba_fraude"),
        F.col("prediction").cast("int").alias("suspect"),
    )
