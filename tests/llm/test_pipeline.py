"""The pipeline, stage by stage and as a whole."""

from __future__ import annotations

import corpus_pipeline
from footfall.llm import decontaminate, quality, simhash


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    good = dict(corpus_pipeline.STAGES)["quality_rules"](spark, docs, sf_dir).cache()
    kept = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == docs.columns
    single = dict(corpus_pipeline.STAGES)["near_dedup"](spark, good, sf_dir).cache()
    groups = {r["component_id"] for r in simhash.near_duplicates(good).collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(groups)
    clean = dict(corpus_pipeline.STAGES)["decontamination"](spark, single, sf_dir).cache()
    leaks = {r["doc_id"] for r in decontaminate.contaminated(single, benchmark).collect()}
    assert {r["doc_id"] for r in clean.collect()} == groups - leaks
    mixed = dict(corpus_pipeline.STAGES)["mixture"](spark, clean, sf_dir)
    assert mixed.columns == docs.columns
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert len(found) == mixed.count()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in mixed.collect())
    assert {r["shard"] for r in found} == set(range(8))
