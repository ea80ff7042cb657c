import corpus_pipeline
from horavento.llm import near_dedup
from horavento.llm.common import table
from horavento.session import materialize
from tests.llm.helpers import SF, docs, prose, word_shingles, links


def test_stages_and_result(spark):
    d = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "packing"]
    kept, ids = d, set()
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.collect()}
        out = materialize(stage(spark, kept, SF), "test-stage")
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= set(before)
        if name != "packing":
            assert out.columns == d.columns
            assert [t for _, t in out.dtypes] == [t for _, t in d.dtypes]
            assert out.where("n_chars <> length(text)").count() == 0
        if name == "near_dedup":
            sets = {i: word_shingles(t, near_dedup.SHINGLE) for i, t in before.items() if i in ids}
            assert links(sets) == []
        kept = out
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids and len(ids) > 50


def test_stages_take_awkward_documents(spark):
    rows = [(1, None), (2, ""), (3, prose(1, 60)), (3, prose(1, 60)), (None, prose(2, 60)), (4, "same line\nsame line\n" + prose(3, 30)),
            (5, prose(1, 60))]
    d = docs(spark, rows).selectExpr("*", "'x' AS row", "1 AS kept", "2 AS good")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, d.limit(0), SF).count() == 0
        got = stage(spark, d, SF)
        if name != "packing":
            assert got.columns == d.columns
        got.collect()
    assert corpus_pipeline.line_stage(spark, d, SF).where("doc_id = 5").count() == 0
