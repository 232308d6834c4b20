"""Scoring and training of the text-quality model, and batched inference with a caller's model."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.blocks import concat_content
from sluice.functions.features import FEATURES, quality_features
from sluice.plans.registry import operator

# The default logistic weights of the demo score.
DEFAULT_WEIGHTS = {
    "intercept": -1.5,
    "entropy": 0.9,
    "unique_words_frac": 1.2,
    "stop_word_frac": 2.0,
    "punc_frac": -6.0,
    "num_frac": -4.0,
    "special_char_frac": -8.0,
    "url_char_frac": -5.0,
    "dup_top_2gram": -3.0,
    "dup_10gram": -2.5,
    "std_dev_unicode_value": -0.002,
}
MIN_ENTROPY = 1.0
_PREFIX = "__f_"


def gated(entropy: Column, score: Column) -> Column:
    """0 for texts of at most one bit per character; the score is not evaluated for them."""
    return F.when(entropy <= MIN_ENTROPY, F.lit(0.0)).otherwise(score)


def logistic(weights: dict[str, float], prefix: str = "") -> Column:
    """Logistic score over feature columns; ``intercept`` is the constant term."""
    unknown = set(weights) - set(FEATURES) - {"intercept"}
    if unknown:
        raise KeyError(f"unknown features: {sorted(unknown)}")
    z = F.lit(float(weights.get("intercept", 0.0)))
    for name, weight in weights.items():
        if name != "intercept":
            z = z + F.col(prefix + name) * F.lit(float(weight))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


@operator("clean_model_demo")
def clean_model(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    src: str = "content_list",
    text_col: str | None = None,
    out: str = "clean_prob",
    on_error: str = "keep",
) -> DataFrame:
    """Add ``clean_prob``: content, entropy gate, features, logistic score.

    The text is the joined content of the block column ``src``, or ``text_col`` when given. A row without
    content gets a NULL score, or is dropped with ``on_error="drop"``.
    """
    original = [F.col(f"`{c}`") for c in df.columns if c != out]
    staged = df.withColumn("__content", F.col(text_col)) if text_col else concat_content(df, src, "__content")
    if on_error == "drop":
        staged = staged.filter(F.col("__content").isNotNull())
    weights = weights or DEFAULT_WEIGHTS
    score = gated(F.col(_PREFIX + "entropy"), logistic(weights, _PREFIX))
    wanted = sorted({"entropy", *weights} - {"intercept"})
    scored = quality_features(staged, "__content", prefix=_PREFIX, features=wanted)
    return scored.select(*original, F.when(F.col("__content").isNotNull(), score).alias(out))


def train_clean_model(
    features: DataFrame, label: str = "quality", cols: tuple[str, ...] = FEATURES, max_iter: int = 50, reg: float = 0.01,
    standardize: bool = True, tol: float = 1e-6,
) -> PipelineModel:
    """Fit a logistic model on feature columns; rows without a label or with NULL features are left out.

    Minimises the mean log loss plus ``reg / 2`` times the squared weights, of the standardised features or, without
    ``standardize``, of the raw ones. The estimator keeps its blocks of training rows in executor storage while it iterates and
    computes lost ones again from ``features``, so pass labelled rows only.
    """
    known = features.select(F.col(label).cast("double").alias("__label"), *cols).na.drop()
    assembler = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="keep")
    model = LogisticRegression(
        featuresCol="__features", labelCol="__label", predictionCol="__prediction", rawPredictionCol="__raw",
        probabilityCol="__probability", maxIter=max_iter, regParam=reg, standardization=standardize, tol=tol,
    )
    return Pipeline(stages=[assembler, model]).fit(known)


def model_weights(model: PipelineModel) -> dict[str, float]:
    """The fitted weights by feature, as :func:`logistic` takes them, so that scoring is one native expression."""
    assembler, fitted = model.stages
    return {"intercept": fitted.intercept, **dict(zip(assembler.getInputCols(), map(float, fitted.coefficients)))}


def score_clean_model(model: PipelineModel, features: DataFrame, out: str = "clean_prob") -> DataFrame:
    """Add the probability of the positive class."""
    scored = model.transform(features)
    return scored.select(
        *[F.col(f"`{c}`") for c in features.columns], vector_to_array("__probability")[1].alias(out)
    )


def _load(factory: Callable | str) -> Callable:
    """A callable, or ``package.module:function`` so that plain JSON configs can name one."""
    if callable(factory):
        return factory
    module, _, name = factory.partition(":")
    return getattr(import_module(module), name)


@operator("model_operator", kind="gpu_model")
def batch_predict(
    df: DataFrame,
    cols: list[str],
    make_predict_fn: Callable[[], Callable] | str,
    return_type: T.DataType | None = None,
    out: str = "prediction",
    batch_size: int = 64,
    input_tensor_shapes: list | None = None,
) -> DataFrame:
    """Add the predictions of a model that is built once per Python worker.

    ``make_predict_fn()`` returns a function from numpy arrays of up to ``batch_size`` rows, one per column, to
    the predictions: numbers, one list of numbers per row for several labels, or strings for generated text,
    as ``return_type`` says. Array columns need their fixed shape in ``input_tensor_shapes``.
    """
    predict = predict_batch_udf(
        _load(make_predict_fn),
        return_type=return_type or T.FloatType(),
        batch_size=batch_size,
        input_tensor_shapes=input_tensor_shapes,
    )
    return df.withColumn(out, predict(*[F.col(c) for c in cols]))
