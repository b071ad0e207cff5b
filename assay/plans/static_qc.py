"""Gates over packages with contents, and what triage makes of all their findings, in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import leaks as L
from assay.operators import sources as S
from assay.operators import triage as T
from assay.plans import files as P
from assay.plans import triage as plan
from assay.plans.registry import ORACLES, query
from assay.session import table, with_checkpoints

# What each gate gives a package in which it finds nothing.
SENTINELS = (("dockerfile", "dockerfile-repro-ok"), ("anti_cheat", "no-static-leakage"), ("tests", "verifier-sources-ok"))


def found(spark: SparkSession, d: str) -> DataFrame:
    """Findings of all file gates and a PASS for each area without any."""
    with_checkpoints(spark)
    made = P.files(spark, d).checkpoint()
    steps = S.docker_instructions(made).checkpoint()
    held = P.delivered(spark, d)
    each = S.docker_findings(made, held, steps).unionByName(S.test_findings(made).select(*S.FINDING)).unionByName(S.verifier_findings(made, held)).unionByName(L.leak_findings(made, steps)).checkpoint()
    per = each.select("task", F.when(F.col("area") == "structure", "tests").otherwise(F.col("area")).alias("area")).distinct()
    every = made.select("task").distinct().select("task", F.explode(F.array(*[F.struct(F.lit(a).alias("area"), F.lit(t).alias("title")) for a, t in SENTINELS])).alias("s")).select("task", "s.*")
    clean = every.join(per, ["task", "area"], "left_anti").select("task", "area", F.lit("PASS").alias("severity"), "title", F.lit("").alias("location"), F.lit("").alias("detail"))
    none = F.lit(None).cast("string")
    return each.unionByName(clean).select(*S.FINDING, none.alias("dimension"), none.alias("ref"))


def signals(spark: SparkSession, d: str) -> DataFrame:
    """Runs of labelled packages: the label of quality says whether the reference passes, that of toxicity whether nothing does."""
    return table(spark, d, "labels").selectExpr("doc_id AS task", "CAST(NULL AS BOOLEAN) AS builds", "quality AS oracle", "toxic AS noop", "CAST(NULL AS INT) AS cheat", "CAST(NULL AS INT) AS mutation")


_TITLED = ", ".join(str(x) for x in S.PYTHON_TITLES)
_TESTS = f"""WITH {P.PYTHON_SQL}, titled(kind, area, title) AS (VALUES {_TITLED})
SELECT task, area, 'FAIL' AS severity, title, 'tests/test_outputs.py' || coalesce(':' || line, '') AS location, coalesce(function, '') AS detail FROM facts JOIN titled USING (kind)"""
_EACH = " UNION ALL ".join(f"SELECT task, area, severity, title, location, detail FROM ({x})" for x in (ORACLES["docker_findings"], _TESTS, ORACLES["verifier_findings"], ORACLES["leak_findings"]))
_FOUND = f"""each AS MATERIALIZED ({_EACH}),
clean AS (SELECT doc_id AS task, area, 'PASS' AS severity, title, '' AS location, '' AS detail FROM (SELECT DISTINCT doc_id FROM documents), (VALUES {', '.join(map(str, SENTINELS))}) AS v(area, title)
  WHERE NOT EXISTS (SELECT 1 FROM each WHERE task = doc_id AND CASE each.area WHEN 'structure' THEN 'tests' ELSE each.area END = v.area)),
f AS (SELECT *, CAST(NULL AS VARCHAR) AS dimension, CAST(NULL AS VARCHAR) AS ref FROM (SELECT * FROM each UNION ALL SELECT * FROM clean))"""
_SIGNALS = "s AS (SELECT doc_id AS task, CAST(NULL AS BOOLEAN) AS builds, quality AS oracle, toxic AS noop, CAST(NULL AS INT) AS cheat, CAST(NULL AS INT) AS mutation FROM labels)"
BUCKETS = plan.BUCKETS_SQL.replace(plan.FOUND_SQL, _FOUND).replace(plan.SIGNALS_SQL, _SIGNALS)


@query(f"WITH {BUCKETS} SELECT * FROM buckets")
def static_buckets(spark, d):
    """From files to buckets: facts of sources, findings, review, priorities and remediation of every package."""
    return T.buckets(T.resolve(found(spark, d)), signals(spark, d)).withColumn("tags", F.array_join("tags", ","))


@query(f"WITH {BUCKETS} SELECT CASE WHEN remediation = '' THEN bucket ELSE bucket || '/' || remediation END AS bucket, priority, count(*) AS n FROM buckets GROUP BY ALL")
def priority_hist(spark, d):
    b = T.buckets(T.resolve(found(spark, d)), signals(spark, d))
    return b.groupBy(F.concat_ws("/", "bucket", F.expr("nullif(remediation, '')")).alias("bucket"), "priority").agg(F.count("*").alias("n"))


@query(f"WITH {BUCKETS} SELECT task, max(severity = 'FAIL') AS blocked, count(*) FILTER (WHERE severity = 'FAIL') AS failures, coalesce(string_agg(DISTINCT CASE WHEN severity = 'FAIL' THEN title END, ',' ORDER BY CASE WHEN severity = 'FAIL' THEN title END), '') AS titles FROM r GROUP BY task")
def static_gate(spark, d):
    bad = F.col("severity") == "FAIL"
    return T.resolve(found(spark, d)).groupBy("task").agg(F.max(bad).alias("blocked"), F.count_if(bad).alias("failures"), F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col("title")))), ",").alias("titles"))
