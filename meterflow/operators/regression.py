"""Linear regression on usage data."""

from functools import reduce
from operator import add, and_, sub

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..checks import require_columns
from .features import assemble


def fit_linear(df, features, label, invalid="error", **params):
    """A fitted least-squares model over the feature columns.

    The normal equations need one pass and a matrix of features squared.
    """
    require_columns(df, *features, label)
    rows = assemble(df.select(*features, F.col(label).cast("double").alias(label)), features, invalid=invalid)
    params = {"solver": "normal", **params}
    return LinearRegression(featuresCol="features", labelCol=label, **params).fit(rows)


def coefficients(spark, model, features):
    """(term, coefficient) rows of a fitted model, the intercept first."""
    terms = [("intercept", float(model.intercept))]
    terms += [(f, float(c)) for f, c in zip(features, model.coefficients)]
    return spark.createDataFrame(terms, "term string, coefficient double")


def predict(df, model, features, invalid="error"):
    """Rows with the model's ``prediction``."""
    return model.transform(assemble(df, features, invalid=invalid)).drop("features")


def residuals(df, label, prediction="prediction", name="residual"):
    require_columns(df, label, prediction)
    return df.withColumn(name, F.col(label) - F.col(prediction))


def metrics(df, label, prediction="prediction"):
    """One row of n, mse, rmse and r2 of the predictions, in one pass.

    r2 is ``1 - residual sum of squares / total sum of squares``; the latter
    is the label's population variance times n.
    """
    require_columns(df, label, prediction)
    rows = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(label) - F.col(prediction)
    sums = rows.agg(
        F.count("*").alias("n"), F.avg(error * error).alias("mse"),
        F.var_pop(label).alias("spread"),
    )
    return sums.select(
        "n", "mse", F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide("mse", "spread")).alias("r2"),
    )


def flag_excess(df, column="prediction", threshold=5.0, name="excess_usage"):
    """1 where the value is above the threshold, else 0; null stays null."""
    require_columns(df, column)
    return df.withColumn(name, (F.col(column) > F.lit(threshold)).cast("int"))


def solve(matrix, right):
    """Columns x with ``matrix`` x = ``right`` for a symmetric positive definite matrix of columns, by elimination.

    Every value is a list entry: an expression over arrays that hold the intermediate
    results, so that nothing is computed twice. A pivot of (nearly) zero gives nulls.
    """
    p = len(right)
    rows = F.array(*[F.array(*matrix[i], right[i]) for i in range(p)])
    scale = [matrix[i][i] for i in range(p)]
    for k in range(p):
        # Divide row k by its pivot, then take it from all others.
        def step(rows, k=k):
            pivot = rows[k][k]
            lead = F.transform(rows[k], lambda v: v / F.when(F.abs(pivot) > F.abs(scale[k]) * 1e-12, pivot))
            return F.transform(
                F.arrays_zip(rows.alias("row"), F.sequence(F.lit(0), F.lit(p - 1)).alias("at")),
                lambda r: F.when(r["at"] == k, lead).otherwise(F.zip_with(r["row"], lead, lambda a, b: a - r["row"][k] * b)),
            )

        rows = step(rows)
    return [rows[i][p] for i in range(p)]


def grouped_fit(df, group, features, label):
    """(group, n, intercept, a coefficient per feature, r2): least squares per group, in one shuffle.

    Tasks send the mergeable means and covariances of each group; the normal equations are
    solved in expressions. The same call on a stream keeps them as state (update
    mode gives the changed groups). Rows with a null in any used column count for
    nothing. Groups with too few rows, or features that depend on each other, have null coefficients; r2 is
    null without spread in the label.
    """
    group, features = list(group), list(features)
    require_columns(df, *group, *features, label)
    used = [F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate([*features, label])]
    rows = df.select(*group, *used).where(reduce(and_, [F.col(f"__x{i}").isNotNull() for i in range(len(used))]))
    p = len(features)
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    sums = rows.groupBy(*group).agg(
        F.count("*").alias("n"), *[F.avg(f"__x{i}").alias(f"__m{i}") for i in range(p + 1)],
        *[F.covar_pop(f"__x{i}", f"__x{j}").alias(f"__c{i}_{j}") for i, j in pairs],
    )
    cov = lambda i, j: F.col(f"__c{min(i, j)}_{max(i, j)}")
    found = solve([[cov(i, j) for j in range(p)] for i in range(p)], [cov(i, p) for i in range(p)])
    enough = F.col("n") > p
    solved = sums.withColumns({f"__b{i}": F.when(enough, b) for i, b in enumerate(found)})
    explained = reduce(add, [F.col(f"__b{i}") * cov(i, p) for i in range(p)])
    intercept = reduce(sub, [F.col(f"__b{i}") * F.col(f"__m{i}") for i in range(p)], F.col(f"__m{p}"))
    return solved.select(
        *group, "n", intercept.alias("intercept"), *[F.col(f"__b{i}").alias(c) for i, c in enumerate(features)],
        F.try_divide(explained, F.nullif(cov(p, p), F.lit(0.0))).alias("r2"),
    )
