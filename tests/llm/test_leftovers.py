"""What the pipeline leaves in the shared folder, and what it sends over the network."""

import os

from pyspark.sql import functions as F

import corpus_pipeline
from assay.llm.store import Scratch, passing, shared_dir


def test_a_stage_leaves_its_output_alone(spark, monkeypatch):
    def stage(session, docs, sf_dir):
        return Scratch(session).keep(docs, "own").withColumn("n_chars", F.length("text").cast("long"))

    docs = spark.createDataFrame([(1, "a b c", "en", "web", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage)])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    root = shared_dir(spark)
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = corpus_pipeline.run(spark, "")
    new = set(os.listdir(root)) - before
    assert len(new) == 1 and [x for n in new for x in os.listdir(f"{root}/{n}")] == ["stage1-1"]
    assert out.count() == 1
    with passing():
        kept = Scratch(spark)
        kept.keep(docs, "x")
    assert not os.path.isdir(kept.root)


def test_texts_stay_where_they_lie_in_the_last_joins(spark):
    rows = [(k, f"w{k} some words of a text", "en", f"s{k % 2}", 5) for k in range(30)] + [(90, "w1 some words of a text", "en", "s1", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.mix_sources):
        out = stage(spark, docs, "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and out.count() >= 15
