"""The pipeline at the smallest size: what each stage promises about its own input."""

import corpus_pipeline
from chronoweave.llm import ngram_join
from chronoweave.llm.scratch import Scratch

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, scratch = spark.read.parquet(f"{DATA}/documents.parquet"), Scratch(spark)
    first = docs.columns
    n = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, DATA))
        assert docs.columns == first, name
        n.append(docs.count())
        if name == "ngram_jaccard_join":
            again = ngram_join.similar_documents(docs, Scratch(spark), 5, 80)
            assert again.where("doc_id <> component_id").count() == 0
    assert n == sorted(n, reverse=True) and n[-1] > 0.5 * n[0]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert mixed.count() == n[-1]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA) if docs.columns else docs
        assert docs.count() == 0
