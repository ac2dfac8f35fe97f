"""Correlations and tests of normality, from mergeable moments and from exact ranks."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..checks import require_columns
from ..functions.normal import normal_cdf, normal_quantile
from .ordered import ranked


def _unpivot(pairs, names):
    entries = [
        F.struct(*[F.lit(k).alias(n) for k, n in zip(key, names)], F.col(c).alias("corr"))
        for key, c in pairs
    ]
    return F.inline(F.array(*entries))


def corr_with(df, features, target):
    """Pearson correlation of every feature with the target, in one pass."""
    require_columns(df, *features, target)
    wide = df.agg(*[F.corr(f, target).alias(f"c{i}") for i, f in enumerate(features)])
    pairs = [((f,), f"c{i}") for i, f in enumerate(features)]
    return wide.select(_unpivot(pairs, ["feature"]))


def corr_matrix(df, columns):
    """All pairwise Pearson correlations as (row, col, corr), in one pass."""
    columns = list(columns)
    require_columns(df, *columns)
    halves = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(halves)])
    pairs = [((a, b), f"c{i}") for i, (a, b) in enumerate(halves)]
    pairs += [((b, a), f"c{i}") for i, (a, b) in enumerate(halves) if a != b]
    return wide.select(_unpivot(pairs, ["row", "col"]))


def normality(df, column):
    """Skewness, excess kurtosis and the Jarque-Bera statistic with its p-value.

    The statistic is compared with a chi-square of two degrees of freedom,
    whose upper tail is ``exp(-x / 2)``.
    """
    require_columns(df, column)
    value = F.col(column).cast("double")
    moments = df.agg(
        F.count(value).alias("n"), F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("kurtosis"),
    )
    statistic = F.col("n") / 6 * (F.pow("skewness", F.lit(2)) + F.pow("kurtosis", F.lit(2)) / 4)
    return moments.withColumn("jarque_bera", statistic).withColumn(
        "p_value", F.exp(-F.col("jarque_bera") / 2)
    )


def normality_by_order(df, column, group=()):
    """(group, n, ks, shapiro_francia) from the exact ranks of all values, per group if given.

    ``ks`` is the Kolmogorov-Smirnov distance to the normal distribution with the
    values' mean and (sample) standard deviation. ``shapiro_francia`` is the squared
    correlation of the sorted values with the normal quantiles of their ranks at
    (rank - 3/8) / (n + 1/4). Ranks come from range slices with carried counts, so no
    task holds more than a slice; equal values take ranks in any order, which
    changes neither figure. Nulls and NaN count for nothing; fewer than two values, or
    equal ones only, give nulls.
    """
    group = list(group)
    require_columns(df, column, *group)
    value = F.col(column).cast("double")
    rows = df.select(*group, value.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    moments = rows.groupBy(*group).agg(F.count("*").alias("__n"), F.avg("__v").alias("__mean"), F.stddev_samp("__v").alias("__sd"))
    # The row number lets equal values span slices.
    placed = ranked(rows.withColumn("__row", F.monotonically_increasing_id()), group, ["__v", "__row"], "__rank")
    if group:
        moments = moments.withColumnsRenamed({c: f"__of_{c}" for c in group})
        joined = placed.join(moments, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in group]))
    else:
        known = moments.first()
        joined = placed.withColumns({c: F.lit(known[c]).cast("long" if c == "__n" else "double") for c in ("__n", "__mean", "__sd")})
    below = normal_cdf((F.col("__v") - F.col("__mean")) / F.nullif("__sd", F.lit(0.0)))
    gap = F.greatest(F.col("__rank") / F.col("__n") - below, below - (F.col("__rank") - 1) / F.col("__n"))
    quantile = normal_quantile((F.col("__rank") - 0.375) / (F.col("__n") + 0.25))
    # The squared correlation; without any spread there is none.
    together = F.pow(F.covar_pop("__v", quantile), F.lit(2))
    spread = F.var_pop("__v") * F.var_pop(quantile)
    return joined.groupBy(*group).agg(
        F.count("*").alias("n"), F.max(F.when(below.isNotNull(), gap)).alias("ks"), F.try_divide(together, F.nullif(spread, F.lit(0.0))).alias("shapiro_francia"),
    )
