"""The registered queries of this subpackage against their SQL twins, and the pipeline."""

import pytest

import corpus_pipeline
from meterflow.llm.queries import ORACLES, QUERIES
from meterflow.llm.registry import read
from tests.oracle import connect, differences

from .samples import awkward, frame, space_words
from .test_exact import families


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_matches_sql(spark, name, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_pipeline_stages(spark, sf):
    """Every stage on its predecessor's rows, compared with what its decision says."""
    docs = read(spark, sf, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "personal_data", "mixing"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = corpus_pipeline.stored(stage(spark, before, sf), f"test-{name}")
        seen.append(kept.count())
        if name != "mixing":
            assert kept.columns == docs.columns and kept.schema == docs.schema
        if name == "near_duplicates":
            listed = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in before.collect()]
            want = {c if n else i for i, n, c in families(listed)}
            assert {r["doc_id"] for r in kept.collect()} == want
        if name == "personal_data":
            assert seen[-1] == seen[-2]
            assert all("@" not in w or "." not in w.partition("@")[2].strip(".,") for r in kept.collect() for w in space_words(r["text"]) if w.count("@") == 1 and w[0].isalnum())
            clean = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert seen[0] > 0.7 * len(rows) and seen == sorted(seen, reverse=True)
    sizes = {r["doc_id"]: r["size"] for r in kept.collect()}
    assert sizes == {i: len(space_words(t)) for i, t in clean.items()}
    final = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert final == sorted(map(tuple, kept.collect()))


def test_pipeline_awkward_rows(spark, tmp_path):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(15)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "item_id long, text string")
    for rows in (awkward(), []):
        docs = frame(spark, rows, key="k", cls=1, score=0.5)
        root = tmp_path / f"rows{len(rows)}"
        for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
            df.write.parquet(f"{root}/{name}.parquet")
        out = corpus_pipeline.run(spark, str(root))
        assert out.count() <= len(rows)
