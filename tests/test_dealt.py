"""A table of one row group is dealt to tasks before its texts are cut up, and what is counted by package stays there."""

import pytest

from assay.operators import leaks as L
from assay.operators import similarity as S
from assay.plans import files as P
from assay.plans import runs

D = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_written_by_package(spark):
    assert "hashpartitioning(task" in plan(P.files(spark, D))


def test_texts_of_files_are_grouped_once(spark):
    rows = [(1, "tests/test.sh", "b"), (1, "tests/test_outputs.py", "a"), (1, "solution/solve.sh", None), (2, "task.toml", "x"), (3, "instruction.md", "told")]
    files = spark.createDataFrame(rows, "task long, rel_path string, text string")
    out = L.texts_of(files, verifier=("tests/test_outputs.py", "tests/test.sh"), solve=("solution/solve.sh",), told=("instruction.md",))
    assert plan(out).count("Exchange hashpartitioning(task") == 1
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a\nb", "", ""), (2, "", "", ""), (3, "", "", "told")]


def test_terms_are_counted_where_their_text_lies(spark, monkeypatch):
    docs, plans = spark.read.parquet(f"{D}/documents.parquet"), []
    monkeypatch.setattr(type(docs), "checkpoint", lambda self: plans.append(plan(self)) or self)
    S.term_counts(docs, "doc_id")
    assert plans[0].count("Exchange") == 1 and "term" not in plans[0][plans[0].index("Exchange") :]


def test_words_of_clusters_are_looked_up_by_all_tasks(spark, monkeypatch):
    def stop(self):
        raise RuntimeError(plan(self))

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", stop)
    with pytest.raises(RuntimeError, match=r"hashpartitioning\(task"):
        runs.clusters(spark, D)
