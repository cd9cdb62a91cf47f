import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carelake.llm import common
from tests.llm.data import odd_documents


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = first = common.table(spark, sf_dir, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, sf_dir))
        counts.append(docs.count())
        if name != "mixing":
            assert docs.columns == first.columns
            assert docs.select("doc_id").distinct().count() == docs.count()
    assert counts[1] > 0.5 * counts[0] and counts == sorted(counts, reverse=True) and counts[4] == counts[3] == counts[5]
    assert docs.filter(F.col("taken") > 2 * F.col("size")).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, sf_dir, name):
    docs = odd_documents(spark)
    stage = dict(corpus_pipeline.STAGES)[name]
    for some in (docs, docs.limit(0)):
        out = stage(spark, some, sf_dir)
        assert name == "mixing" or out.columns == docs.columns
        assert out.count() <= some.count()
