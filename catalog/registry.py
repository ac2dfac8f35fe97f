"""Where the catalog modules put their queries."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function and its SQL twin."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add
