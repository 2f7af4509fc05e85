"""The pipeline's stages against their operators and brute force."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tidemark.llm import common, rules, toxicity  # noqa: E402
from tidemark.llm.queries import fertility_vocabularies, vocabulary  # noqa: E402

from .test_search import brute_join  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_pipeline_equals_its_parts(spark):
    documents = common.table(spark, SF, "documents")
    model = toxicity.train(documents, common.table(spark, SF, "labels"))
    toxic = {r["doc_id"] for r in toxicity.score(documents, model).collect() if r["predicted"]}
    failed = {r["doc_id"] for r in rules.score(documents, fertility_vocabularies()).collect() if not r["kept"]}
    left = [(r["doc_id"], r["text"]) for r in documents.collect() if r["doc_id"] not in toxic | failed]
    expected = {doc for doc, n, component in brute_join(left) if doc == component or not n}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == expected and toxic and failed


def test_stages_keep_the_columns_of_documents(spark):
    documents = common.table(spark, "/root/testdata/sf0.001", "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, "/root/testdata/sf0.001").columns == documents.columns


def test_stages_of_no_documents(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0
