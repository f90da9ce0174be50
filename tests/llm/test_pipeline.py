"""The pipeline's stages take effect one after the other, and return the columns of documents."""

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        result = spark.read.parquet(f"{tmp_path}/{name}")
        if number < 4:
            assert result.columns == columns and 0 < result.count() <= before
            assert result.count() == result.select("doc_id").distinct().count()
            before, docs = result.count(), result
    kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in result.collect()} == kept
