"""Extra columns of any name pass through what keeps rows whole; equal rows don't crowd a language out."""

import sys

import pytest

from parley.llm import langid, quality, resemblance, suffix

NAMES = ("a-b", "a b", "a.b", "row", "host", "p", "lang_pred", "hash")


def _docs(spark, texts, lang="en"):
    rows = [(i, t, lang, "s", len(t), *([str(i)] * len(NAMES))) for i, t in enumerate(texts)]
    fields = ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {fields}")


@pytest.mark.parametrize("kept", [langid.keep_known, resemblance.one_of_each, suffix.without_repeats, "quality"])
def test_columns_of_any_name_come_back(spark, kept):
    docs = _docs(spark, [f"some words of text number {i} and the rest of the line {i * i}" for i in range(12)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    got = quality.keep_good(docs, labels) if kept == "quality" else kept(docs)
    assert got.columns == docs.columns
    assert all(r["a.b"] == r["a b"] == r["a-b"] == r["host"] == str(r["doc_id"]) for r in got.collect())


def test_equal_rows_do_not_crowd_a_language_out(spark):
    rows = [(1, "the very same words of one document", "en")] * 400 + [(i, f"un autre texte numéro {i}", "fr") for i in range(2, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for _ in range(2):
        assert langid.fit(docs, fit_docs=5).languages == ("en", "fr")


def test_queries_run_from_another_folder(sf_dir, tmp_path):
    import os
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        "import sys, importlib.util as u\n"
        f"s = u.spec_from_file_location('__spark_entry__', {os.path.join(root, '__spark_entry__.py')!r}); m = u.module_from_spec(s); s.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        f"print('rows', m.queries()['op12_pages'](spark, {sf_dir!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 50" in done.stdout, done.stderr[-2000:]
