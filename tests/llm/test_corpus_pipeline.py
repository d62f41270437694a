import corpus_pipeline


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    from tierline.llm.common import Store

    store = Store(spark)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, store.keep(stage(spark, docs, sf_dir), name)
        counts.append(docs.count())
        if name != "sequence_packing":
            assert docs.columns == columns
        if name == "near_duplicates":
            assert docs.select("doc_id").distinct().count() == counts[-1]
            assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "secret_masking":
            assert docs.where("text like '%***%'").count() >= before.where("text like '%***%'").count()
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    assert {"sequence_id", "offset"} <= set(docs.columns)
