from __future__ import annotations

import pytest

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, "x", 1)], [(1, "", "en", "web", 0, None, None)]])
def test_pipeline_of_nothing(spark, tmp_path, rows):
    """An empty table, a row of nulls and an empty text: every stage runs, columns with clashing names are ignored, nothing is left."""
    spark.createDataFrame(rows, f"{COLUMNS}, score string, copy int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).where("length > 1").count() == 0
