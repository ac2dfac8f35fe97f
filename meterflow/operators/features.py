"""Feature vectors and train/test splits."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..checks import require_choice, require_columns


def assemble(df, columns, name="features", invalid="error"):
    """Numeric columns as one vector; ``invalid`` says what nulls do."""
    require_columns(df, *columns)
    require_choice("invalid", invalid, ("error", "skip", "keep"))
    assembler = VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid=invalid)
    return assembler.transform(df)


def split_random(df, weights=(0.7, 0.3), seed=42):
    """Random parts; the rows of each depend on how the input is partitioned."""
    return df.randomSplit(list(weights), seed=seed)


def in_train(key, train_tenths=7):
    """Predicate: the row's integer key falls in the training share."""
    if not 0 < train_tenths < 10:
        raise ValueError("train_tenths must be 1 to 9")
    return F.pmod(F.col(key), F.lit(10)) < train_tenths


def split_by_key(df, key, train_tenths=7):
    """(train, test) by an integer key: the same rows however data is laid out."""
    require_columns(df, key)
    keep = in_train(key, train_tenths)
    return df.filter(keep), df.filter(~keep)
