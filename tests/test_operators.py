import json

import pytest
from pyspark.sql import functions as F

from assay.functions import text as T
from assay.operators import attempts as A
from assay.operators import findings as N
from assay.sources import readers, writers
from assay.streaming import attempts as stream


def test_pass_needs_a_number(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (0.99,)], "s double")
    assert [r[0] for r in df.select(A.is_pass(F.col("s"))).collect()] == [True, False, False, False]


def test_unknown_area_counts_in_overall(spark):
    f = spark.createDataFrame([("t", "contract", "FAIL", "x", "static"), ("t", "tests", "WARN", "y", "static"), ("u", "tests", "odd", "z", "static")], "task string, area string, severity string, title string, layer string")
    rows = {r["task"]: r for r in N.verdicts(f).collect()}
    assert rows["t"]["overall"] == "FAIL" and rows["t"]["tests"] == "WARN" and rows["t"]["structure"] is None
    assert rows["u"]["overall"] == "PASS"


def test_scorecard_undefined_is_null(spark):
    p = spark.createDataFrame([("a", False)], "task string, flagged boolean")
    lab = spark.createDataFrame([("a", False)], "task string, is_defect boolean")
    r = N.scorecard(p, lab).first()
    assert r["precision"] is None and r["tn"] == 1


def test_sources(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps([{"task": "a", "area": "tests"}, {"area": "x"}], indent=2))
    (tmp_path / "g.json").write_text(json.dumps({"findings": [{"task": "b", "area": "tests", "severity": "FAIL", "title": "t"}]}))
    rows = sorted((r["task"], r["severity"], r["title"]) for r in readers.findings(spark, f"{tmp_path}/*.json").collect())
    assert rows == [("a", "PASS", ""), ("b", "FAIL", "t")]
    (tmp_path / "l.csv").write_text("task,is_defect,expected_verdict,expected_title,kind,source,notes\n # c,,,,,,\na,Yes,,,,,\nb,0,,,,,\n")
    assert sorted((r["task"], r["is_defect"]) for r in readers.labels(spark, f"{tmp_path}/l.csv").collect()) == [("a", True), ("b", False)]


def test_task_tree_and_parsers(spark, tmp_path):
    root = tmp_path / "in" / "one"
    (root / "environment").mkdir(parents=True)
    (root / "task.toml").write_text('a = "x # y" # note\n[env]\ncpus = 2\ntags = [\n "p",\n "q"]\ncpus = 3\n')
    (root / "environment" / "Dockerfile").write_text("# c\nFROM a\nRUN x \\\n  && y\n")
    files = readers.task_files(spark, str(tmp_path / "in"))
    got = {r["rel_path"]: r for r in files.select("rel_path", readers.parse_toml("text").alias("t"), readers.parse_dockerfile("text").alias("d")).collect()}
    assert got["task.toml"]["t"]["a"] == "x # y" and got["task.toml"]["t"]["env.cpus"] == "3"
    assert [(x["line"], x["instr"], x["args"]) for x in got["environment/Dockerfile"]["d"]] == [(2, "FROM", "a"), (3, "RUN", "x && y")]


def test_append_is_idempotent_and_merge(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert writers.append_new(df, f"{tmp_path}/t", ["k"]) == 2
    assert writers.append_new(df, f"{tmp_path}/t", ["k"]) == 0
    old = spark.createDataFrame([("a", {"x": "1", "y": "2"}), ("b", {"x": "1"})], "k string, fields map<string,string>")
    new = spark.createDataFrame([("a", {"x": "3"}), ("b", {"x": "1"})], "k string, fields map<string,string>")
    assert [(r["k"], r["fields"]) for r in writers.merge_fields(old, new, "k").collect()] == [("a", {"x": "3", "y": "2"})]


def test_stream_counts_an_attempt_once(spark, tmp_path):
    rows = [("t1", "a", "2024-01-01 00:00:00", True), ("t1", "a", "2024-01-01 00:05:00", True), ("t2", "a", "2024-01-01 00:01:00", False)]
    spark.createDataFrame(rows, "id string, task string, ts string, genuine boolean").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(f"{tmp_path}/in")
    src = spark.readStream.schema("id string, task string, ts timestamp, genuine boolean").parquet(f"{tmp_path}/in")
    q = stream.once(src, "id", "ts").writeStream.format("memory").queryName("once_rows").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination()
    assert sorted(r["id"] for r in spark.sql("select id from once_rows").collect()) == ["t1", "t2"]


def test_text_functions(spark):
    d = "--- a/x\n+++ b/x.py\n+new\n-old\n"
    r = spark.createDataFrame([(d, "ab ```c\nd``` e")], "d string, t string").select(T.added_lines(F.col("d")), T.changed_paths(F.col("d")), T.visible_length(F.col("t"))).first()
    assert r[0] == ["new"] and r[1] == ["x.py"] and r[2] == 4


def test_nested_roots_and_flat_files(spark, tmp_path):
    for folder in ("in/one", "in/one/inner", "in/deep/two", "in/.git/x"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "task.toml").write_text("a = 1")
    got = {(r["task"], r["rel_path"]) for r in readers.task_files(spark, str(tmp_path / "in")).collect()}
    assert got == {("one", "task.toml"), ("one", "inner/task.toml"), ("two", "task.toml")}
    flat = readers.flat_files(spark, str(tmp_path / "in"), "task.toml").collect()
    assert {(r["folder"], r["file"]) for r in flat} == {("one", "task.toml")}


def test_tabs_scores_exports_and_yaml(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("t1\tOK\t3\n\nt2\tBAD\tx\nt3\n")
    rows = [tuple(r) for r in readers.tab_lines(spark, f"{tmp_path}/a.tsv", ["task", "verdict", "n"], ("n",)).collect()]
    assert rows == [("t1", "OK", 3), ("t2", "BAD", 0), ("t3", None, 0)]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "run_score_0.5.json").write_text("{}\n{}")
    (tmp_path / "s" / "odd.json").write_text("{}")
    assert {(r["file"], r["score"]) for r in readers.scored_files(spark, f"{tmp_path}/s").collect()} == {("run_score_0.5.json", 0.5), ("odd.json", None)}
    (tmp_path / "e.json").write_text(json.dumps({"batches": [{"name": "b", "tasks": [{"task": "t", "attempts": [{"id": "1", "model": "m", "score": 1.0}, {"id": "2"}]}, {"task": "u", "attempts": []}]}]}, indent=1))
    assert {(r["task"], r["attempt"], r["score"]) for r in readers.exported_attempts(spark, f"{tmp_path}/e.json").collect()} == {("t", "1", 1.0), ("t", "2", None)}
    assert readers.yaml_pairs("a: 1 # n\nb: 'x # y'\ntags:\n  - p\n  - q\ntext: |\n  one\n\n  two\n???\n") == {"a": "1", "b": "x # y", "tags": "p\nq", "text": "one\n\ntwo"}
    assert readers.yaml_pairs(None) == {} and readers.toml_pairs("= \n[[\nx") == {"": ""}


def test_gate_files_and_defects(spark, tmp_path):
    gated = spark.createDataFrame([("b", False, "static", "x"), ("a", False, "static", "y"), ("c", True, "", "")], "task string, promoted boolean, layers string, titles string")
    writers.write_gate(gated, f"{tmp_path}/g")
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/g/quarantine").collect()]
    assert sorted(lines) == ["# task\tlayers\ttitles", "a\tstatic\ty", "b\tstatic\tx"]
    assert [r[0] for r in spark.read.text(f"{tmp_path}/g/promoted").collect()] == ["c"]
    rows = [("t", "P2", "WARN", "tests", "d"), ("t", "", "WARN", "tests", "d"), ("t", "P0", "FAIL", "tests", "d")]
    writers.write_defects(spark.createDataFrame(rows, "task string, priority string, severity string, area string, detail string").coalesce(1), f"{tmp_path}/d")
    assert {r["priority"] for r in spark.read.option("header", True).csv(f"{tmp_path}/d").collect()} == {"P0", "P2", None}
    writers.write_report(gated, f"{tmp_path}/r", "task")
    assert spark.read.option("header", True).csv(f"{tmp_path}/r").count() == 3
    writers.write_findings(gated, f"{tmp_path}/f")
    assert spark.read.json(f"{tmp_path}/f").count() == 3


def test_strict_and_lenient_attempts(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"trajectory_id": "1", "score": 1.0}\n\nnot json\n')
    assert [r["trajectory_id"] for r in readers.attempts(spark, f"{tmp_path}/a.json", strict=False).collect()] == ["1"]
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        readers.attempts(spark, f"{tmp_path}/a.json").collect()


def test_top_up_counts_ids_once_and_stops(spark, tmp_path):
    """Batch by batch, with ids delivered again after exhaustion, a restart between the batches and an earlier run."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "id string, task string, genuine boolean"
    batches = [
        [("1", "t", True), ("1", "t", True), ("2", "t", False), ("3", "u", False), ("4", "u", False), ("5", "u", False), ("6", "u", False), ("0", "w", True)],
        [("3", "u", True), ("6", "u", True), ("2", "t", True), ("7", "w", None)],
        [("7", "t", True), ("8", "u", True), ("8", "u", True)],
    ]
    resume = spark.createDataFrame([("0", "w", True), ("9", "w", False)], schema)
    want = [
        {"t": (1, 2, 1, False), "u": (0, 4, 0, True), "w": (1, 2, 1, False)},
        {"t": (1, 2, 1, False), "u": (0, 4, 0, True), "w": (1, 3, 1, False)},
        {"t": (2, 3, 0, False), "u": (1, 5, 0, True)},
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        src = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        # each batch is a query of its own that goes on from the checkpoint
        out = stream.top_up(src, 2, 2, resume).writeStream
        got = {}

        def keep(df, _, got=got):
            got.update({r["task"]: (r["genuine"], r["attempts"], r["need"], r["exhausted"]) for r in df.collect()})

        q = out.foreachBatch(keep).outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
        q.awaitTermination()
        assert got == want[k]


def test_more_text_functions(spark):
    rows = [(bytearray(b"plain text\n"), "a.txt"), (bytearray(b"a\0b"), "a.txt"), (bytearray(b"\x01\x02abc"), "a"), (bytearray(b""), "a"), (bytearray(b"x"), "a.PNG"), (None, "a")]
    got = spark.createDataFrame(rows, "c binary, p string").select(T.is_binary(F.col("c"), F.col("p"))).collect()
    assert [r[0] for r in got] == [False, True, True, False, True, False]
    r = spark.range(1).select(T.percent(F.lit(0.256)), T.model_family(F.lit("Vendor/Model-X ")), T.basename(F.lit("a/b.txt")), T.flat(F.lit(" a \n b ")), T.embedded_array(F.lit('say [{"a": 1}] ok'), "array<struct<a:int>>")).first()
    assert tuple(r)[:4] == ("25.6%", "model-x", "b.txt", "a b") and r[4][0]["a"] == 1
