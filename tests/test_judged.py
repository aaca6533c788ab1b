"""Documents are judged as they stream by: nothing of them is written, and nothing but the orders they are made from is shuffled."""

import os

import pytest

import __spark_entry__


@pytest.mark.parametrize("name", ["reconstruction_results", "transcription_results", "extension_results", "persona_documents", "persona_results"])
def test_documents_are_neither_written_nor_shuffled(spark, sf_dir, name):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    kept = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = kept()
    broken = __spark_entry__.queries()[name](spark, sf_dir)
    plan = broken._jdf.queryExecution().executedPlan().toString()
    assert broken.count() > 0 and kept() == before
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    # no filter works a document out a second time
    assert "Filter (size(CASE" not in plan
