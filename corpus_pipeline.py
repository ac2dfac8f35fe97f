"""Corpus preparation in five stages over ``documents``.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each result to the shared checkpoint folder and
reads it again as the next stage's input. Empty tables, nulls, repeated rows
and extra columns are handled as the stages' operators state.
"""

from pyspark.sql import functions as F

from meterflow.llm import decontaminate, jaccard_join, mixing, pii, quality
from meterflow.llm.registry import read
from meterflow.llm.store import discard, stored

# The quality model and the near duplicate search cannot be put in SQL.
ORACLE_SQL = None


def good_quality(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject."""
    labels = quality.learnable(read(spark, sf_dir, "labels"))
    _, model = quality.train(docs, labels)
    return quality.keep_good(docs, model)


def without_near_copies(spark, docs, sf_dir):
    """One document, that with the smallest id, of every group of near duplicates."""
    return jaccard_join.keep_one(docs)


def without_leaks(spark, docs, sf_dir):
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_leaked(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the new text."""
    clean = pii.redact_pii(docs)
    if "n_chars" in docs.columns:
        changed = F.size("pii_spans") > 0
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixed(spark, docs, sf_dir):
    """Words to take of every document so that sources meet their target shares."""
    return mixing.op_mix(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_leaks),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
]


def run(spark, sf_dir):
    docs, made = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        made.append(docs)
        discard(*made[:-1])
        del made[:-1]
    return STAGES[-1][1](spark, docs, sf_dir)
