"""The registered queries on the smallest tables, and what the pipeline's stages keep."""

import corpus_pipeline
from pelagia.llm import common

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_drop_what_they_reject(spark):
    docs = common.table(spark, SF, "documents")
    extra = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, None, None)], docs.schema)
    docs, seen = docs.unionByName(extra), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.written(stage(spark, docs, SF), f"test-{name}")
        assert kept.columns == docs.columns
        before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in (docs, kept))
        assert after <= before
        seen.append(len(before - after))
        docs = kept
    assert seen[1] >= 2  # the texts without a letter
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == after
