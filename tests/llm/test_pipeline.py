import corpus_pipeline
from skein.llm.common import stored, table

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = first = table(spark, DATA, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DATA), f"test-{name}")
        assert docs.columns == first.columns and docs.count() > 0
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    want = sorted((r.doc_id, r.n_tokens) for r in rows.collect())
    assert want == sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, DATA).collect())
    assert "@" not in "".join(r.text for r in docs.collect())
