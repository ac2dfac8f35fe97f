"""Arrow operators run when the session was started from another folder."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
df = spark.createDataFrame([(1, "write to a.b@c.org now"), (2, None)], "doc_id long, text string")
from meterflow.llm import pii
print("spans", sum(r["n_email"] for r in pii.op_digest(df).collect()))
"""


def test_workers_get_the_package(tmp_path):
    plain = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=plain, capture_output=True, text=True, timeout=300)
    assert "spans 1" in done.stdout, done.stderr[-2000:]
