"""Send this package to the Python workers of a session.

Functions given to ``mapInArrow`` and its relatives are pickled by reference, so
a worker has to be able to import them wherever the driver was started from.
"""

import tempfile
import zipfile
from pathlib import Path

PACKAGE = Path(__file__).resolve().parent
# Folders of the archives by application; the driver serves them until it ends.
_SHIPPED = {}


def ship(spark):
    """Make the package importable on all executors, once per application.

    The archive goes through the driver's file server; nothing is shipped when
    the package itself was loaded from an archive that the executors have.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not PACKAGE.is_dir():
        return
    _SHIPPED[app] = folder = tempfile.TemporaryDirectory()
    name = str(Path(folder.name, f"{PACKAGE.name}.zip"))
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(name)


def mapped(df, fn, schema):
    """``df.mapInArrow(fn, schema)`` with the package at hand: ``df.transform(mapped, fn, schema)``."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
