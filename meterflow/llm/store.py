"""Tables written once to the shared checkpoint folder and read back."""

from ..durable import remove_folders, work_dir


def stored(df, label, compression="snappy"):
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut."""
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(*tables):
    """Delete tables made by ``stored`` that no later step reads."""
    for table in tables:
        remove_folders(table.sparkSession, [table._stored_at])
