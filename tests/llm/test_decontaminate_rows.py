"""Contaminated rows are removed by row, not by id."""

import corpus_pipeline
from tabml.llm import decontaminate as D


def test_rows_are_removed_not_ids(spark, tmp_path):
    run = "a b c d e f g h i j"
    docs = spark.createDataFrame([(None, run), (None, "clean row"), (7, f"x {run}"), (7, "clean too"), (8, None)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, run)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    want = {(None, "clean row"), (7, "clean too"), (8, None)}
    assert {tuple(r) for r in D.remove_contaminated_rows(docs, bench).collect()} == want
    assert {tuple(r) for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()} == want
