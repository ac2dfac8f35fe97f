"""The last n rows per key of a stream, as state of n rows per key."""

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..checks import require_columns
from ..shipping import ship

_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_ORDER = ["at", "tie", "row"]


def _trim(batches, keys, n):
    """The first n rows per key of every Arrow batch, so that a busy key sends few rows to its state."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table.sort_by([*[(k, "ascending") for k in keys], *[(c, "descending") for c in _ORDER]])
        place = table.select(keys).to_pandas().groupby(keys, dropna=False, sort=False).cumcount()
        yield from table.filter(pa.array(place.to_numpy() < n)).to_batches()


def _keep(key, parts, state, keys, n):
    """Merge new rows into a key's state and give its current rows if they changed."""
    held = list(zip(*state.get, strict=True)) if state.exists else []
    rows = list(held)
    for part in parts:
        rows += zip(part["at"].tolist(), part["tie"].tolist(), part["row"].tolist(), strict=True)
    rows = sorted(rows, reverse=True)[:n]
    if rows == held:
        return
    state.update(tuple(map(list, zip(*rows, strict=True))))
    out = pd.DataFrame({"rank": range(1, len(rows) + 1), "row": [r for _, _, r in rows]})
    for name, value in zip(reversed(keys), reversed(key), strict=True):
        out.insert(0, name, [value] * len(rows))
    yield out


def last_n_stream(df, keys, n, ts="timestamp", tiebreak=None):
    """The newest ``n`` rows per key over everything seen so far, with ``rank`` from 1.

    Run it in update mode: a batch gives all current rows of every key whose rows changed, and
    ``current_rows`` reads the result. Newest means by ``ts``, then by ``tiebreak`` (a column of
    whole numbers, without nulls), then by content, so late rows find their place and equal rows all count.
    State is ``n`` rows per key, whatever the stream brings; what falls
    behind is forgotten. Tasks trim their rows to ``n`` per key before the shuffle. Rows without a time
    are left out; null keys are keys like any other. A key column's type has to be one that
    pandas keeps (text, numbers).
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    keys = list(keys)
    require_columns(df, *keys, ts, *([tiebreak] if tiebreak else []))
    ship(df.sparkSession)
    rest = [c for c in df.columns if c not in keys]
    start = F.lit("1970-01-01").cast(df.schema[ts].dataType.simpleString())
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, F.timestamp_diff("MICROSECOND", start, F.col(ts)).alias("at"),
        (F.col(tiebreak).cast("long") if tiebreak else F.lit(0).cast("long")).alias("tie"), F.to_json(F.struct(*rest), _TIMES).alias("row"),
    )
    trimmed = rows.mapInArrow(lambda it: _trim(it, keys, n), rows.schema)
    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    found = trimmed.groupBy(*keys).applyInPandasWithState(
        lambda key, parts, state: _keep(key, parts, state, keys, n),
        f"{key_types}, rank int, row string", "ats array<bigint>, ties array<bigint>, contents array<string>",
        "update", GroupStateTimeout.NoTimeout,
    )
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest)
    opened = found.withColumn("row", F.from_json("row", schema, _TIMES))
    return opened.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns], "rank")


def current_rows(log, keys, batch="batch_id"):
    """The rows each key had last in a log of ``last_n_stream`` batches."""
    keys = list(keys)
    require_columns(log, *keys, batch)
    names = {k: f"__{i}" for i, k in enumerate(keys)}
    last = log.groupBy(*keys).agg(F.max(batch).alias("__last")).withColumnsRenamed(names)
    same = F.col(batch) == F.col("__last")
    for k, name in names.items():
        same = same & F.col(k).eqNullSafe(F.col(name))
    return log.join(last, same).select(*[c for c in log.columns if c != batch])
