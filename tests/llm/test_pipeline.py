import corpus_pipeline
from docweave.llm import common
from docweave.llm.near_dedup import near_dedup
from docweave.llm.secrets import base_spans

SF = "/root/testdata/sf0.001"


def test_decisions_of_every_stage_take_effect(spark):
    docs = common.documents(spark, SF)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, SF), name)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == common.documents(spark, SF).columns
    texts = [r.text for r in seen["exact_dedup"].collect()]
    assert len(texts) == len(set(texts)) == seen["toxicity"].select("text").distinct().count()
    near = seen["minhash_near_dedup"]
    assert near_dedup(near, 5).where("not stays").count() == 0
    clean = seen["secret_scans"].collect()
    assert len(clean) == near.count() and not any(base_spans(r.text) for r in clean)
    packed = seen["best_fit_packing"]
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in clean}
