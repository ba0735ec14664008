import corpus_pipeline
from recsmith.llm import pii, queries


def test_stages_and_run(spark, sf, docs, texts):
    now, seen = docs, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.write.mode("overwrite").parquet(path := f"{spark.sparkContext.getCheckpointDir()}/stage{i}")
            out = spark.read.parquet(path)
        seen[name] = out.collect()
        now = out
    quality = {r["doc_id"] for r in queries.QUERIES["op9_quality_rules"](spark, sf).filter("kept").collect()}
    assert {r["doc_id"] for r in seen["quality_rules"]} == quality
    group = {r["doc_id"]: r["component_id"] for r in queries.QUERIES["op1_simhash_dedup"](spark, sf).collect()}
    kept = [r["doc_id"] for r in seen["simhash_dedup"]]
    assert len({group[i] for i in kept}) == len(kept) and set(kept) <= quality
    for r in seen["personal_data"]:
        assert pii.base_spans(r["text"]) == [] or r["text"] == texts[r["doc_id"]] or "[" in r["text"]
        if r["text"] == texts[r["doc_id"]]:
            assert pii.base_spans(r["text"]) == []
        else:
            assert r["n_chars"] == len(r["text"])
    assert {r["doc_id"] for r in seen["mixing"]} <= set(kept)
    assert {r["doc_id"] for r in seen["packing"]} == {r["doc_id"] for r in seen["mixing"]}
    total = sum(r["length"] for r in seen["packing"])
    assert sum(r["length"] for r in corpus_pipeline.run(spark, sf).collect()) == total


def test_every_stage_takes_odd_rows(spark, sf, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, sf)
        if name != "packing":
            assert out.columns == odd_docs.columns, name
        out.collect()
        assert stage(spark, no_docs, sf).count() == 0, name
