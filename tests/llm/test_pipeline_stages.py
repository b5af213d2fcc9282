"""The pipeline on the smallest tables, each stage held against its own input."""

import corpus_pipeline
from wardlens.llm import decontaminate, jaccard_join, mixing, toxicity
from wardlens.llm.catalog import queries
from wardlens.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, seen = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs = jaccard_join.materialize(docs, "test-stage")
        seen[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = seen["toxicity"]
    scores = toxicity.classify_toxicity(before, table(spark, SF, "labels"))
    assert ids(after) == ids(scores.filter("predicted = 0"))
    before, after = seen["near-duplicates"]
    assert ids(after) == ids(jaccard_join.near_duplicates(before).filter("doc_id = component_id"))
    before, after = seen["decontamination"]
    assert ids(before) - ids(after) == ids(decontaminate.contaminated(before, table(spark, SF, "benchmark")))
    before, after = seen["mixing"]
    assert ids(after) == ids(mixing.mix(before).filter("taken > 0"))
    before, after = seen["tokens"]
    assert after.count() == before.count()
    starts = [r.start for r in after.orderBy("start").collect()]
    assert starts[0] == 0 and starts == sorted(starts)


def test_queries_are_complete():
    assert sorted(queries(), key=lambda n: int(n[2:].split("_")[0])) == [n for n in sorted(
        queries(), key=lambda n: int(n[2:].split("_")[0]))] and len(queries()) == 13
