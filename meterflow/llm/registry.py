"""Queries of this subpackage and their SQL twins."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
