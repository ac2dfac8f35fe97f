"""Consumption model: clean a text table, fit, predict, evaluate, check residuals."""

from dataclasses import dataclass

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame

from ..operators import clean, features, regression, stats

# Columns of the household consumption table (fixed names).
TARGET = "Global_active_power"
FEATURES = ("Voltage", "Global_intensity", "Sub_metering_1", "Sub_metering_2", "Sub_metering_3")


@dataclass(frozen=True)
class Fitted:
    model: LinearRegressionModel
    predictions: DataFrame
    metrics: DataFrame
    normality: DataFrame


def cleaned(table, columns=(*FEATURES, TARGET), keep=()):
    """Numeric columns, rows with a gap removed; ``keep`` carries other columns along."""
    return clean.drop_incomplete(clean.to_numeric(table, columns), columns).select(*keep, *columns)


def fit(table, columns=FEATURES, target=TARGET, weights=(0.7, 0.3), seed=42, key=None):
    """A model of the target, judged on the held-out part.

    The split is random, or by an integer ``key`` column (7 of 10 for training),
    which gives the same parts however the data is laid out.
    """
    rows = cleaned(table, (*columns, target), () if key is None else (key,))
    train, test = features.split_random(rows, weights, seed) if key is None else features.split_by_key(rows, key)
    model = regression.fit_linear(train, list(columns), target)
    predicted = regression.residuals(regression.predict(test, model, list(columns)), target)
    return Fitted(
        model, predicted, regression.metrics(predicted, target), stats.normality(predicted, "residual")
    )
