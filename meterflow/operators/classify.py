"""Logistic regression with parameters and per-fit overrides."""

from functools import reduce
from operator import add

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from ..checks import require_columns
from .features import assemble


def fit_logistic(df, features, label="label", params=None, overrides=None):
    """A fitted model; ``overrides`` replace ``params`` for this fit only.

    ``features`` is a list of numeric columns, or the name of a vector column.
    Names are those of the estimator: maxIter, regParam, threshold,
    probabilityCol and so on.
    """
    vector = features if isinstance(features, str) else "features"
    require_columns(df, label, *([features] if isinstance(features, str) else features))
    rows = df if isinstance(features, str) else assemble(df, features)
    estimator = LogisticRegression(featuresCol=vector, labelCol=label, **(params or {}))
    changed = {}
    for name, value in (overrides or {}).items():
        if not estimator.hasParam(name):
            raise ValueError(f"unknown parameter {name!r}")
        changed[estimator.getParam(name)] = value
    rows = rows.select(vector, F.col(label).cast("double").alias(label))
    return estimator.fit(rows, changed)


def class_probabilities(model, inputs):
    """The class probabilities as columns: the model's weights written into the plan.

    ``inputs`` are the feature columns in the order of the fit. No fitted object
    travels with the plan, and the sums stay inside generated code.
    """
    weights, offsets = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    margins = [
        reduce(add, [F.lit(float(w)) * x.cast("double") for w, x in zip(row, inputs, strict=True)], F.lit(float(b)))
        for row, b in zip(weights, offsets, strict=True)
    ]
    if len(margins) == 1:
        positive = 1 / (1 + F.exp(-margins[0]))
        return [1 - positive, positive]
    top = F.greatest(*margins)
    parts = [F.exp(m - top) for m in margins]
    return [p / reduce(add, parts) for p in parts]


def predict_class(df, model, features, positive="positive_probability"):
    """Rows with the class probabilities (an array), the prediction and the positive class's probability.

    The columns are named as the model's parameters say. The prediction follows
    ``threshold`` for two classes, else the likeliest class (the first of equals).
    Rows with a null feature get nulls.
    """
    if isinstance(features, str):
        from pyspark.ml.functions import vector_to_array

        require_columns(df, features)
        values = vector_to_array(F.col(features))
        inputs = [values[k] for k in range(model.numFeatures)]
    else:
        require_columns(df, *features)
        inputs = [F.col(c) for c in features]
    chances = F.array(*class_probabilities(model, inputs))
    name = model.getProbabilityCol()
    scored = df.withColumn(name, F.when(chances[0].isNotNull(), chances))
    if model.numClasses == 2:
        predicted = (F.col(name)[1] > model.getThreshold()).cast("double")
    else:
        predicted = (F.array_position(name, F.array_max(name)) - 1).cast("double")
    return scored.withColumns({model.getPredictionCol(): predicted, positive: F.col(name)[1]})
