"""Reliable storage for cut lineage and intermediate tables.

Everything goes to the shared folder the cluster names in
``spark.checkpoint.dir``, so losing executors never loses a cut plan.
"""

import logging
import tempfile
import uuid

log = logging.getLogger(__name__)


def checkpoint_root(spark):
    """The session's shared checkpoint folder, made known to the context.

    Off one machine the folder has to be named. A ``file:`` folder there is
    taken at the cluster's word (it may be a shared mount), with a warning.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = context.getCheckpointDir()
    on_one_machine = context.master.startswith("local") and not context.master.startswith("local-cluster")
    if not root:
        if not on_one_machine:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir=None)
    if context.getCheckpointDir() is None:
        if root.startswith("file:") and not on_one_machine:
            log.warning("%s must be a mount that all executors share", root)
        context.setCheckpointDir(root)
    return root


def work_dir(spark, label):
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df):
    """``df`` computed once, stored reliably, with its lineage cut.

    Set ``spark.cleaner.referenceTracking.cleanCheckpoints`` to have the files
    removed once nothing refers to the result.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_folders(spark, paths):
    """Delete folders through the file system they live in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        at = hadoop(path)
        at.getFileSystem(conf).delete(at, True)
