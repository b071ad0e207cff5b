"""Answers of judging models and verifiers, made from the words of whole documents, and the queries over them.

As in ``files`` every line becomes a piece, and the SQL says from the lines alone what must be found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import judges as J
from assay.operators import verifiers as V
from assay.operators.sources import TEST_PY
from assay.plans.files import _LN, _lines, _written
from assay.plans.registry import query
from assay.session import ship, table, with_checkpoints

DIMENSIONS = (*J.DIMENSIONS, "style")
# Elements of an answer by length of the line, modulo their number; {d} is the dimension of the line.
SAID = (
    '{"dimension": "{d}", "area": "tests", "severity": "WARN", "title": "{w}", "detail": "q{i}: {w}"}',
    '{"dimension": "{d}", "area": "tests", "severity": "WARN", "title": "{w}", "detail": " ", "task": "other"}',
    '{"dimension": "{d}", "area": "solution", "severity": "FAIL", "title": "{w}", "location": "a.py:{i}", "layer": "static"}',
    '{"dimension": "{d}", "area": "tests", "title": "{w}", "detail": "Q1: Q2 : {w}"}',
    '"{w}]"',
    '{"dimension": "{d}", "area": "", "severity": "FAIL", "detail": "{w}"}',
    '{"area": "tests", "severity": "WARN", "title": {n}, "detail": ["{w}"]}',
)
TESTS = (
    'def test_{i}():\n    os.system("diff -q a {w}")',
    'def test_{i}():\n    assert sha256("{w}") == sha256(x)',
    'def test_{i}():\n    open("/tests/.truth/{w}")',
    'def test_{i}():\n    run("jq .{w} == 1; sha256sum {w}")',
    'def test_{i}():\n    assert run("plain.py", "{w}") == "PASSED_OK"',
    'def test_{i} ():\n    run("strict.sh", "{w}")',
    'def test_{i}():\n    exec(b64decode("ZGlmZiAtcSBh"))',
    'def test_{i}():\n    assert work("{w}")',
)


def answers(spark: SparkSession, d: str) -> DataFrame:
    """(task, role, stop_reason, text): one answer for each document; a review where the text's length is even."""
    docs = table(ship(spark), d, "documents").select(F.col("doc_id").alias("task"), F.length(F.coalesce("text", F.lit(""))).alias("size"), _lines().alias("lines"))

    def element(x):
        text = F.element_at(F.array(*map(F.lit, SAID)), x["n"] % len(SAID) + 1)
        text = F.replace(text, F.lit("{d}"), F.element_at(F.array(*map(F.lit, DIMENSIONS)), (x["n"] + x["i"]) % len(DIMENSIONS) + 1))
        for name in "wni":
            text = F.replace(text, F.lit(f"{{{name}}}"), x[name].cast("string"))
        return text

    array = F.array_join(F.transform("lines", element), ",\n")
    kind = F.col("size") % 9
    text = F.when(kind == 1, "no findings").when(kind == 2, F.concat(F.lit("["), array, F.lit(",]"))).when(kind == 3, None).when(kind == 4, "all is well: []").otherwise(F.concat(F.lit("Here they are:\n```json\n["), array, F.lit("]\n```\nThat is all.")))
    return docs.select("task", F.when(F.col("size") % 2 == 0, J.REVIEWER).otherwise("adversary").alias("role"), F.when(kind == 0, "refusal").otherwise("end_turn").alias("stop_reason"), text.alias("text"))


_CHECKS = ", ".join(str((q, d, a)) for q, (d, a) in J.CHECKS.items())
_JUDGED = f"""WITH {_LN},
doc AS (SELECT doc_id AS task, length(coalesce(text, '')) % 9 AS kind, CASE WHEN length(coalesce(text, '')) % 2 = 0 THEN 'reviewer' ELSE 'adversary' END AS role FROM documents),
el AS (SELECT task, role, n % 7 AS k, {list(DIMENSIONS)}[(n + i) % 10 + 1] AS dim, w, n, i FROM ln JOIN doc USING (task) WHERE kind > 4),
said AS MATERIALIZED (
  SELECT task, role, CASE WHEN k < 6 THEN dim END AS dimension, CASE k WHEN 2 THEN 'solution' ELSE 'tests' END AS area, CASE k WHEN 2 THEN 'FAIL' ELSE 'WARN' END AS severity, CASE k WHEN 6 THEN CAST(n AS VARCHAR) ELSE w END AS title,
    CASE k WHEN 2 THEN 'a.py:' || i END AS location, CASE k WHEN 0 THEN 'q' || i || ': ' || w WHEN 1 THEN ' ' WHEN 6 THEN '["' || w || '"]' END AS detail, CASE k WHEN 2 THEN 'static' ELSE 'semantic' END AS layer
  FROM el WHERE k IN (0, 1, 2, 6)
  UNION ALL SELECT task, role, NULL, 'tests', 'WARN', CASE kind WHEN 0 THEN 'judge-refused' ELSE 'judge-unparsable' END, NULL, CASE kind WHEN 0 THEN 'the judge declined this task' WHEN 2 THEN 'not JSON' ELSE 'no array' END, 'semantic' FROM doc WHERE kind < 4),
dims(dimension, area) AS (VALUES {', '.join(map(str, J.DIMENSIONS.items()))}), checks(q, dimension, area) AS (VALUES {_CHECKS}),
every AS (
  SELECT * FROM said
  UNION ALL SELECT doc.task, 'reviewer', dims.dimension, dims.area, 'FAIL', 'dimension-not-assessed', '', CASE WHEN s.task IS NULL THEN 'not-assessed' ELSE 'asserted-without-evidence' END, 'semantic'
    FROM doc CROSS JOIN dims LEFT JOIN (SELECT task, dimension, bool_or(coalesce(trim(detail), '') <> '' OR location IS NOT NULL) AS shown FROM said GROUP BY ALL) s ON s.task = doc.task AND s.dimension = dims.dimension
    WHERE role = 'reviewer' AND NOT coalesce(shown, false)
  UNION ALL SELECT doc.task, 'reviewer', checks.dimension, checks.area, 'FAIL', 'mandatory-check-not-assessed', '', q, 'semantic'
    FROM doc CROSS JOIN checks WHERE role = 'reviewer' AND NOT EXISTS (SELECT 1 FROM said WHERE said.task = doc.task AND starts_with(detail, lower(q) || ':')))
SELECT * FROM every"""


@query(_JUDGED)
def judge_findings(spark, d):
    """What judging models found, what of it was lost, and what the reviews left out."""
    return J.judged(answers(spark, d)).select("task", "role", "dimension", "area", "severity", "title", "location", "detail", "layer")


def verifiers(spark: SparkSession, d: str) -> DataFrame:
    """(task, rel_path, text): a verifier for each document, with two graders where the text's length is even."""
    docs = table(ship(spark), d, "documents").select(F.col("doc_id").alias("task"), F.length(F.coalesce("text", F.lit(""))).alias("size"), _lines().alias("lines"))
    more = {"tests/plain.py": "print(1)", "tests/strict.sh": "cmp -s a b", "tests/test.sh": "diff -q plain.py b", "tests/lib/deep.py": "import hashlib"}
    each = [F.struct(F.lit(TEST_PY).alias("rel_path"), _written(TESTS, F.lit("import os")).alias("text"))]
    each += [F.when(F.col("size") % 2 == 0, F.struct(F.lit(p).alias("rel_path"), F.lit(t).alias("text"))) for p, t in more.items()]
    return docs.select("task", F.explode(F.array_compact(F.array(*each))).alias("f")).select("task", "f.rel_path", "f.text")


def failing(spark: SparkSession, d: str) -> DataFrame:
    """(task, check): two of three functions fail everywhere, and one check that no function has."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("task"), F.explode(_lines()).alias("x"))
    return docs.where("(x.n + x.i) % 3 > 0").select("task", F.concat(F.lit("tests/test_outputs.py::"), F.when(F.col("x.n") % 8 > 6, "X::").otherwise(""), F.lit("test_"), F.col("x.i")).alias("check"))


_HITS = f"""CASE WHEN k IN (0, 6) OR (k = 5 AND size % 2 = 0) THEN '{V.MARKS["byte-exact-compare"][1]}' WHEN k = 1 THEN '{V.MARKS["hash-equality"][1]}' WHEN k = 2 THEN '{V.MARKS["hidden-oracle-truth"][1]}'
  WHEN k = 3 THEN '{V.MARKS["hash-equality"][1]}; {V.MARKS["jq-deep-equal"][1]}' WHEN k = 4 AND size % 2 = 0 THEN 'delegates to graders that show nothing, and asks for their sentinel' END"""


@query(f"""WITH {_LN}, t AS (SELECT task, i, n, {_HITS.replace('k ', 'n % 8 ')} AS hit FROM ln)
SELECT task, 'tests' AS area, 'WARN' AS severity, CASE WHEN hit IS NULL THEN 'escalate-oracle' ELSE 'brittle-verifier-pattern' END AS title, 'tests/test_outputs.py::test_' || i AS location, coalesce(hit, 'fails everywhere and shows no mark') AS detail FROM t WHERE (n + i) % 3 > 0""")
def verifier_functions(spark, d):
    """Test functions that fail in every attempt, by the comparison that they make."""
    with_checkpoints(spark)
    return V.verifier_findings(verifiers(spark, d).checkpoint(), failing(spark, d))
