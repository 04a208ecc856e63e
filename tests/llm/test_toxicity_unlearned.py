import pytest

import corpus_pipeline
from tracklens.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("marks", [[], [(1, 1, None)], [(1, 1, 1), (2, 1, 1)], [(2, 1, 0)]], ids=str)
def test_nothing_is_rejected_without_both_classes(spark, tmp_path, odd, marks):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert kept.columns == odd.columns and kept.count() == odd.count()
    rows = QUERIES["op3_toxicity"](spark, str(tmp_path)).collect()
    assert len(rows) == odd.count() and {r.predicted for r in rows} == {0}
    assert len({r.score for r in rows}) == 1 and rows[0].score < 0.5
