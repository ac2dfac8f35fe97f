"""Argument checks that fail while the plan is built, not while it runs."""


def require_columns(df, *names):
    """Raise if ``df`` lacks one of ``names`` (dotted names check the root)."""
    missing = [n for n in names if n.split(".")[0] not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def require_choice(what, value, choices):
    if value not in choices:
        raise ValueError(f"unknown {what} {value!r}; choose from {list(choices)}")


def hashable_columns(df):
    """Columns that ``xxhash64`` and ``orderBy`` accept (no maps or variants)."""
    return [
        f.name
        for f in df.schema.fields
        if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    ]
