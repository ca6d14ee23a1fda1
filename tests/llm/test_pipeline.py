import corpus_pipeline
from eventlens.llm import minhash, quality

SF = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "pack":
                assert out.columns == docs.columns and out.count() <= docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "personal_data", "pack"]


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in quality.accepted(docs, quality.fit(docs, labels)).collect()}
    left = docs.where(docs.doc_id.isin(sorted(kept)))
    kept = {r.doc_id for r in minhash.keep_one(left).collect()}
    packed = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert packed <= kept and len(packed) > 0.8 * len(kept)
