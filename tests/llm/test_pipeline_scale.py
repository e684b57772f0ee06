"""Stages of the pipeline move keys, not texts, while the keys are few."""

import corpus_pipeline as cp


def test_few_rejected_documents_leave_without_a_shuffle_of_the_texts(spark, tmp_path):
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    text = " ".join(words)
    rows = [(1, text), (2, "a b c d e"), (3, f"x {text} y"), (4, "a b c d e"), (2, "a b c d e"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(7, " ".join(words[:11]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean, once = cp.drop_contaminated(spark, docs, str(tmp_path)), cp.drop_near_copies(spark, docs, str(tmp_path))
        for stage, want in ((clean, [None, 2, 2, 4]), (once, None)):
            assert "LeftAnti" in (plan := stage._jdf.queryExecution().optimizedPlan().toString())
            assert plan.count("strategy=broadcast") >= plan.count("LeftAnti")
            got = sorted((r["doc_id"] for r in stage.collect()), key=lambda x: (x is not None, x))
            assert want is None or got == want
            assert want or {1, 2, None} <= set(got) and got.count(2) == 1 and 4 not in got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
