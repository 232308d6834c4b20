"""Boosted trees over text features, compiled to column expressions, and models that are stored and loaded as plain files.

A model here is a dict of numbers and names (``kind``, and what belongs to it), so it is stored as one JSON record, needs no class of the
session that fitted it, and is scored by native expressions: nested conditions for trees, a sum for logistic weights.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.blocks import concat_content
from sluice.functions.features import FEATURES, quality_features
from sluice.operators.models import _PREFIX, gated, logistic, model_weights
from sluice.plans.registry import operator


def train_tree_model(
    features: DataFrame, label: str = "quality", cols: tuple[str, ...] = FEATURES, trees: int = 20, depth: int = 4, step: float = 0.3, seed: int = 7,
) -> tuple[VectorAssembler, Any]:
    """Fit gradient-boosted trees on feature columns; rows without a label or with NULL features are left out.

    The estimator keeps its training rows in executor storage while it iterates and computes lost ones again, so pass labelled rows only.
    Returns the assembler and the fitted model, whose ``transform`` gives ``__probability``.
    """
    known = features.select(F.col(label).cast("double").alias("__label"), *cols).na.drop()
    assembler = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="keep")
    estimator = GBTClassifier(
        featuresCol="__features", labelCol="__label", predictionCol="__prediction", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed,
    ).setRawPredictionCol("__raw").setProbabilityCol("__probability")
    return assembler, estimator.fit(assembler.transform(known))


def _node(node: Any, cols: list[str]) -> dict:
    if node.getClass().getSimpleName() == "LeafNode":
        return {"value": node.prediction()}
    split = node.split()
    return {"feature": cols[split.featureIndex()], "at_most": split.threshold(), "then": _node(node.leftChild(), cols), "else": _node(node.rightChild(), cols)}


def tree_spec(assembler: VectorAssembler, model: Any) -> dict:
    """Fitted trees as a plain model."""
    cols = assembler.getInputCols()
    return {"kind": "trees", "weights": list(model.treeWeights), "trees": [_node(t._call_java("rootNode"), cols) for t in model.trees]}


def logistic_spec(model: PipelineModel) -> dict:
    """A fitted logistic model (:func:`sluice.operators.models.train_clean_model`) as a plain model."""
    return {"kind": "logistic", "weights": model_weights(model)}


def model_features(spec: dict) -> list[str]:
    """The feature columns that a model reads."""
    if spec["kind"] == "logistic":
        return sorted(set(spec["weights"]) - {"intercept"})

    def names(node: dict) -> set[str]:
        return {node["feature"]} | names(node["then"]) | names(node["else"]) if "feature" in node else set()

    return sorted(set().union(*map(names, spec["trees"])))


def tree_score(spec: dict, prefix: str = "") -> Column:
    """Probability of the positive class: each tree as nested conditions, the weighted sum through the logistic function."""
    def value(node: dict) -> Column:
        if "value" in node:
            return F.lit(float(node["value"]))
        return F.when(F.col(f"`{prefix}{node['feature']}`") <= F.lit(float(node["at_most"])), value(node["then"])).otherwise(value(node["else"]))

    margin = reduce(Column.__add__, [value(t) * F.lit(float(w)) for t, w in zip(spec["trees"], spec["weights"])], F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def model_score(spec: dict, prefix: str = "") -> Column:
    """Score of a plain model over feature columns."""
    if spec.get("kind") == "logistic":
        return logistic(spec["weights"], prefix)
    if spec.get("kind") == "trees":
        return tree_score(spec, prefix)
    raise ValueError(f"unknown kind of model {spec.get('kind')!r}; known: logistic, trees")


def save_model(spark: SparkSession, spec: dict, path: str) -> None:
    """Store a plain model; replaces one that is there."""
    model_score(spec)  # a model that cannot be scored is not stored
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_model(spark: SparkSession, path: str) -> dict:
    """A stored model. A folder without exactly one record is an error."""
    rows = spark.read.text(path).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path!r} does not hold one model")
    return json.loads(rows[0].value)


@operator("stored_model")
def stored_model(
    df: DataFrame, model_path: str, src: str = "content_list", text_col: str | None = None, out: str = "clean_prob",
) -> DataFrame:
    """Add the score of a stored model behind the entropy gate; a row without content gets a NULL score. Works on streams."""
    spec = load_model(df.sparkSession, model_path)
    original = [F.col(f"`{c}`") for c in df.columns if c != out]
    staged = df.withColumn("__content", F.col(text_col)) if text_col else concat_content(df, src, "__content")
    scored = quality_features(staged, "__content", prefix=_PREFIX, features=sorted({"entropy", *model_features(spec)}))
    score = gated(F.col(_PREFIX + "entropy"), model_score(spec, _PREFIX))
    return scored.select(*original, F.when(F.col("__content").isNotNull(), score).alias(out))
