"""Reconciliation, completeness and triage over findings made up from ``events`` and signals from ``labels``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import triage as T
from assay.operators.findings import AREAS
from assay.plans.registry import query
from assay.session import table

TITLES = [*T.P0[:8], *T.P1[:12], *T.P2[:3], "untested-requirement", "golden-patch-mismatch", "semantic-cheat-vector", "missing-category", "odd-title", *T.META, "verifier-defended", "verifier-defended", "weak-assertion"]
DIMS = [*T.DIMENSIONS, None, "alignment", "realism"]
DETAILS = ["", " ", "seen at\n line 3", "recompute-or-hash of the output", "re-exec-agent only", None]
PLACES = [*AREAS, "contract"]
LEVELS = ["FAIL", "WARN", "PASS", "PASS", "odd"]


def _literal(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


class Pick:
    """A value of a list by a whole-number index, as SQL and as a column (made when asked for, as that needs a session)."""

    def __init__(self, values: list, index: str):
        self.values, self.index = values, index
        self.sql = f"([{', '.join(map(_literal, values))}])[{index} % {len(values)} + 1]"

    @property
    def column(self):
        at = F.expr(f"cast({self.index.replace('//', 'div')} % {len(self.values)} + 1 as int)")
        return F.element_at(F.array(*map(F.lit, self.values)), at)


_COLS = {"area": Pick(PLACES, "(event_id // 7)"), "severity": Pick(LEVELS, "(event_id // 3)"), "title": Pick(TITLES, "event_id"), "location": Pick(["", "f1", None], "(event_id // 2)"), "detail": Pick(DETAILS, "(event_id // 5)"), "dimension": Pick(DIMS, "(event_id // 11)"), "ref": Pick(TITLES, "(event_id * 5 + 3)")}
FOUND_SQL = "f AS (SELECT event_id // 4 AS task, " + ", ".join(f"{p.sql} AS {k}" for k, p in _COLS.items()) + " FROM events)"
SIGNALS_SQL = "s AS (SELECT doc_id AS task, CASE WHEN doc_id % 9 > 0 THEN doc_id % 50 <> 1 END AS builds, CASE WHEN doc_id % 9 > 0 THEN quality END AS oracle, CASE WHEN doc_id % 9 > 0 THEN toxic END AS noop, CASE WHEN doc_id % 9 > 4 THEN doc_id % 2 END AS cheat, CASE WHEN doc_id % 9 > 0 AND doc_id % 3 > 0 THEN doc_id % 2 END AS mutation FROM labels)"


def _findings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.expr("event_id div 4").alias("task"), *[p.column.alias(k) for k, p in _COLS.items()])


def _signals(spark: SparkSession, d: str) -> DataFrame:
    ran = "doc_id % 9 > 0"
    return table(spark, d, "labels").selectExpr("doc_id AS task", f"CASE WHEN {ran} THEN doc_id % 50 <> 1 END AS builds", f"CASE WHEN {ran} THEN quality END AS oracle", f"CASE WHEN {ran} THEN toxic END AS noop", "CASE WHEN doc_id % 9 > 4 THEN doc_id % 2 END AS cheat", f"CASE WHEN {ran} AND doc_id % 3 > 0 THEN doc_id % 2 END AS mutation")


def _in(titles) -> str:
    return "(" + ", ".join(f"'{t}'" for t in titles) + ")"


_HARD = " OR ".join(f"contains(coalesce(detail, ''), '{d}')" for d in T.HARD_DEFENCES)
RESOLVED_SQL = f"""{FOUND_SQL}, marks AS (SELECT task, coalesce(bool_or(title = 'cheat-vector-confirmed'), false) AS c, coalesce(bool_or(title = 'cheat-vector-refuted'), false) AS r, coalesce(bool_or(title = 'verifier-defended'), false) AS d, coalesce(bool_or(title = 'verifier-defended' AND ({_HARD})), false) AS h FROM f GROUP BY task),
gone AS (SELECT DISTINCT task, ref AS title FROM f WHERE title = 'verify-refuted' AND ref <> ''),
r AS (SELECT f.task, area, CASE WHEN title = 'semantic-cheat-vector' THEN CASE WHEN c THEN 'FAIL' ELSE 'WARN' END WHEN title = 'agent-writable-verifier' AND severity = 'FAIL' AND h THEN 'WARN' ELSE severity END AS severity, title, location, detail, dimension, ref
  FROM f JOIN marks USING (task) WHERE title NOT IN {_in(T.META)} AND NOT (title = 'semantic-cheat-vector' AND (r OR d)) AND (f.task, title) NOT IN (SELECT (task, title) FROM gone))"""
_DIM_ROWS = ", ".join(f"('{d}', '{a}', 'semantic', NULL)" for d, a in T.DIMENSIONS.items()) + ", " + ", ".join(f"('{d}', '{a}', 'behavioral', '{c}')" for d, (c, a) in T.SIGNALS.items())
GAPS_SQL = f"""{SIGNALS_SQL}, dims AS (SELECT * FROM (VALUES {_DIM_ROWS}) AS v(dimension, area, layer, signal)),
tasks AS (SELECT task FROM r UNION SELECT task FROM s),
gaps AS (SELECT t.task, dims.dimension, dims.area, layer, CASE WHEN signal IS NULL AND EXISTS (SELECT 1 FROM r WHERE r.task = t.task AND r.dimension = dims.dimension) THEN 'asserted-without-evidence' ELSE 'not-assessed' END AS reason
  FROM tasks t CROSS JOIN dims LEFT JOIN s ON s.task = t.task
  WHERE CASE WHEN signal IS NULL THEN NOT EXISTS (SELECT 1 FROM r WHERE r.task = t.task AND r.dimension = dims.dimension AND (trim(coalesce(detail, '')) <> '' OR trim(coalesce(location, '')) <> ''))
    ELSE CASE signal WHEN 'oracle' THEN oracle WHEN 'noop' THEN noop ELSE mutation END IS NULL END)"""


@query(f"WITH {RESOLVED_SQL} SELECT * FROM r")
def findings_resolved(spark, d):
    return T.resolve(_findings(spark, d))


@query(f"WITH {RESOLVED_SQL}, {GAPS_SQL} SELECT * FROM gaps")
def completeness_gaps(spark, d):
    return T.gaps(T.resolve(_findings(spark, d)), _signals(spark, d))


@query(f"WITH {RESOLVED_SQL}, {GAPS_SQL}, a AS (SELECT task, area, severity, title FROM r UNION ALL SELECT task, area, 'FAIL', 'qc-incomplete' FROM gaps) SELECT area, severity, title, count(*) AS n FROM a GROUP BY ALL")
def completeness_injected(spark, d):
    return T.with_gaps(T.resolve(_findings(spark, d)), _signals(spark, d)).groupBy("area", "severity", "title").agg(F.count("*").alias("n"))


PRIORITY_SQL = f"CASE WHEN title IN {_in(T.P0)} THEN 'P0' WHEN title IN {_in(T.P1)} THEN 'P1' WHEN title IN {_in(T.P2)} THEN 'P2' WHEN severity = 'FAIL' AND area IN ('anti_cheat', 'tests', 'dataset') THEN 'P0' WHEN severity = 'FAIL' THEN 'P1' WHEN severity = 'WARN' THEN 'P2' ELSE '' END"
BUCKETS_SQL = f"""{RESOLVED_SQL}, {SIGNALS_SQL}, k AS (SELECT *, {PRIORITY_SQL} AS p, title <> '{T.SOFT}' AS real FROM r WHERE severity IN ('FAIL', 'WARN')),
g AS (SELECT task, coalesce(min(p) FILTER (WHERE real), '') AS priority, bool_or(real AND severity = 'FAIL') AS failed, arg_min(area, list_position([{', '.join(map(repr, PLACES))}], area)) FILTER (WHERE real AND severity = 'FAIL') AS first,
  bool_or(title IN {_in(T.BROKEN)}) AS broken, bool_or(title IN {_in(T.CONCRETE)}) AS concrete, bool_or(title IN {_in(T.RELOCATE)}) AS relocate, bool_or(title IN {_in(T.STRENGTHEN)}) AS strengthen, bool_or(title IN {_in(T.ALIGN)}) AS align FROM k GROUP BY task),
t AS (SELECT DISTINCT task FROM r),
j AS (SELECT t.task, coalesce(priority, '') AS priority, coalesce(failed, false) AS failed, first, coalesce(broken, false) AS broken, coalesce(concrete, false) AS concrete, coalesce(relocate, false) AS relocate, coalesce(strengthen, false) AS strengthen, coalesce(align, false) AS align, builds, oracle, noop, cheat,
  s.task IS NOT NULL AS ran, s.task IS NOT NULL AND (builds IS NOT NULL OR oracle IS NOT NULL OR noop IS NOT NULL OR cheat IS NOT NULL OR mutation IS NOT NULL) AS confirmed FROM t LEFT JOIN g USING (task) LEFT JOIN s ON s.task = t.task),
b AS (SELECT *, CASE WHEN NOT builds OR oracle = 0 OR broken OR noop = 1 OR cheat = 1 THEN 'total' WHEN failed OR priority = 'P0' OR concrete THEN 'fixable' WHEN priority = 'P1' THEN 'review' ELSE 'ship' END AS bucket FROM j),
o AS (SELECT *, CASE bucket WHEN 'total' THEN CASE WHEN NOT builds THEN 'unviable' WHEN oracle = 0 OR broken THEN 'broken-oracle' ELSE 'gameable' END
  WHEN 'fixable' THEN CASE WHEN relocate THEN 'relocate' WHEN concrete OR strengthen THEN 'strengthen' WHEN align THEN 'align' WHEN first = 'metadata' THEN 'metadata' WHEN first = 'structure' THEN 'add-file' WHEN first = 'dockerfile' THEN 'dockerfile' ELSE 'review' END ELSE '' END AS remediation,
  CASE bucket WHEN 'ship' THEN 'passing' WHEN 'fixable' THEN 'needs-fixing' WHEN 'total' THEN 'defective-hard' ELSE 'needs-review' END AS status, NOT ran AND bucket IN ('fixable', 'review') AS needs_behavioral FROM b),
buckets AS (SELECT task, bucket, status, remediation, priority, CASE WHEN confirmed THEN 'confirmed' ELSE 'candidate' END AS confidence, needs_behavioral,
  concat_ws(',', 'qc:' || bucket, 'qc:' || status, CASE WHEN remediation = '' THEN NULL WHEN bucket = 'total' THEN 'qc:' || remediation ELSE 'qc:fix-' || remediation END, CASE WHEN priority <> '' THEN 'qc:' || lower(priority) END, CASE WHEN confirmed THEN 'qc:confirmed' ELSE 'qc:candidate' END, CASE WHEN needs_behavioral THEN 'qc:needs-behavioral' END) AS tags FROM o)"""


@query(f"WITH {BUCKETS_SQL} SELECT * FROM buckets")
def triage_buckets(spark, d):
    return T.buckets(T.resolve(_findings(spark, d)), _signals(spark, d)).withColumn("tags", F.array_join("tags", ","))


@query(f"WITH {RESOLVED_SQL} SELECT task, {PRIORITY_SQL} AS priority, severity, area, title, trim(regexp_replace(coalesce(detail, ''), '\\s+', ' ', 'g')) AS detail FROM r WHERE severity IN ('FAIL', 'WARN')")
def defect_rows(spark, d):
    return T.defects(T.resolve(_findings(spark, d)))


@query(f"WITH {RESOLVED_SQL}, v AS (SELECT task, area AS gate, max(CASE WHEN severity = 'FAIL' AND title IN {_in(T.P0)} THEN 2 WHEN severity IN ('FAIL', 'WARN') THEN 1 ELSE 0 END) AS k FROM r GROUP BY ALL) SELECT task, gate, CASE k WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS verdict FROM v")
def calibrated_gate(spark, d):
    blocking = spark.range(1).select(F.explode(F.array(*map(F.lit, T.P0))).alias("title"))
    return T.calibrated(T.resolve(_findings(spark, d)), blocking)


_STATUS = "CASE WHEN severity = 'FAIL' THEN 'fail' WHEN severity = 'WARN' THEN 'neutral' ELSE 'clean' END"


@query(f"WITH {FOUND_SQL}, x AS (SELECT task, area, title, {_STATUS} AS status FROM f) SELECT task, CASE WHEN bool_or(status = 'fail') THEN 'fail' WHEN bool_or(status = 'neutral') THEN 'neutral' ELSE 'clean' END AS verdict, coalesce(string_agg(DISTINCT CASE WHEN status = 'fail' THEN area || ' / ' || title END, ',' ORDER BY CASE WHEN status = 'fail' THEN area || ' / ' || title END), '') AS failed FROM x GROUP BY task")
def module_roll_up(spark, d):
    dims = _findings(spark, d).groupBy("task", "area").agg(F.collect_list(F.struct(F.col("title").alias("dim"), F.expr(_STATUS).alias("status"))).alias("dims"))
    sections = dims.groupBy("task").agg(F.collect_list(F.struct(F.col("area").alias("name"), "dims")).alias("modules"))
    return T.roll_up(sections).withColumn("failed", F.array_join("failed", ","))


# rewards and exit codes of made-up container runs
_NR, _OR = Pick(["1", "0", "1.0", "", None, "x"], "event_id"), Pick(["1", "1.0000000001", "0.5", "", None, "1"], "(event_id // 6)")
_NC, _OC = "event_id // 2 % 3", "event_id // 4 % 2"


def _one_sql(x: str) -> str:
    return f"coalesce(abs(TRY_CAST({x} AS DOUBLE) - 1) < 1e-9, false)"


def _policy_sql(good: str, free: str) -> str:
    return f"CASE WHEN NOT ({good}) THEN 'ORACLE-FAIL' WHEN {free} THEN 'NOOP-PASS' ELSE 'OK' END"


_EITHER = "CASE WHEN coalesce({r}, '') <> '' THEN {one} ELSE {c} = 0 END"


@query(f"WITH c AS (SELECT event_id, {_NR.sql} AS nr, {_OR.sql} AS orr, {_NC} AS nc, {_OC} AS oc FROM events) SELECT event_id, {_policy_sql('oc = 0', 'nc = 0')} AS by_exit, {_policy_sql(_one_sql('orr'), _one_sql('nr'))} AS by_reward, {_policy_sql(_EITHER.format(r='orr', one=_one_sql('orr'), c='oc'), _EITHER.format(r='nr', one=_one_sql('nr'), c='nc'))} AS by_either, {_policy_sql('oc = 0', 'false')} AS by_oracle FROM c")
def container_verdicts(spark, d):
    runs = table(spark, d, "events").select("event_id", _NR.column.alias("nr"), _OR.column.alias("orr"), F.expr(_NC.replace("//", "div")).alias("nc"), F.expr(_OC.replace("//", "div")).alias("oc"))
    cols = [F.col(c) for c in ("nr", "nc", "orr", "oc")]
    return runs.select("event_id", *[T.container_verdict(p, *cols).alias(f"by_{p}") for p in ("exit", "reward", "either", "oracle")])


_BEHAVIOR = "CASE WHEN golden IS NULL THEN 'unknown' WHEN golden < 1 THEN 'broken-oracle' WHEN coalesce(empty, 0) > 0 THEN 'noop-passes' ELSE 'oracle-healthy' END"


@query(f"WITH g AS (SELECT doc_id, CASE WHEN doc_id % 7 > 0 THEN CAST(quality AS DOUBLE) END AS golden, CASE WHEN doc_id % 5 > 0 THEN CAST(toxic AS DOUBLE) END AS empty FROM labels), v AS (SELECT doc_id, {_BEHAVIOR} AS verdict FROM g) SELECT doc_id, verdict, CASE WHEN verdict IN ('broken-oracle', 'noop-passes') THEN 'fail' WHEN verdict <> 'unknown' THEN 'pass' END AS oracle, CASE WHEN verdict IN ('broken-oracle', 'noop-passes') THEN 'defective-hard' END AS status, CASE verdict WHEN 'broken-oracle' THEN 'broken-oracle' WHEN 'noop-passes' THEN 'gameable' END AS remediation FROM v")
def behavioral_labels(spark, d):
    runs = table(spark, d, "labels").selectExpr("doc_id", "CASE WHEN doc_id % 7 > 0 THEN CAST(quality AS DOUBLE) END AS golden", "CASE WHEN doc_id % 5 > 0 THEN CAST(toxic AS DOUBLE) END AS empty")
    rows = runs.select("doc_id", T.behavioral_verdict(F.col("golden"), F.col("empty")).alias("verdict"))
    label = T.behavioral_label(F.col("verdict"))
    return rows.select("doc_id", "verdict", *[label[c].alias(c) for c in ("oracle", "status", "remediation")])


_ORACLES = Pick(["OK", "ORACLE-FAIL", "NOOP-PASS", "pending", "BUILD-FAIL", "OK"], "l.doc_id")


@query("WITH leak AS (SELECT user_id AS doc_id, count(*) FILTER (WHERE value > 400) AS hits, bool_or(event_type = 'error' AND value > 300) AS noop FROM events GROUP BY user_id), m AS (SELECT l.doc_id, coalesce(" + _ORACLES.sql + ", 'pending') AS o, CASE WHEN k.doc_id IS NULL THEN 'n/a' WHEN noop THEN 'NOOP-PASS' WHEN hits > 0 THEN 'LEAK-CONFIRMED' ELSE 'clean' END AS leak FROM labels l LEFT JOIN leak k ON k.doc_id = l.doc_id) SELECT doc_id, o AS oracle, leak, CASE WHEN o IN ('ORACLE-FAIL', 'NOOP-PASS', 'BUILD-FAIL', 'EXC', 'EXEC-ERROR') OR leak IN ('LEAK-CONFIRMED', 'NOOP-PASS') THEN 'CULL' ELSE 'READY' END AS verdict, concat_ws(';', CASE WHEN o IN ('ORACLE-FAIL', 'NOOP-PASS', 'BUILD-FAIL', 'EXC', 'EXEC-ERROR') THEN 'oracle:' || o END, CASE WHEN leak IN ('LEAK-CONFIRMED', 'NOOP-PASS') THEN 'leak:' || leak END) AS reasons FROM m")
def cull_or_ready(spark, d):
    """A manifest with what several sources say of each task, missing ones named, and the verdict."""
    e, manifest = table(spark, d, "events"), table(spark, d, "labels").alias("l")
    leak = e.groupBy(F.col("user_id").alias("id")).agg(F.count_if(F.col("value") > 400).alias("hits"), F.bool_or((F.col("event_type") == "error") & (F.col("value") > 300)).alias("noop"))
    kind = F.when(F.col("id").isNull(), "n/a").when(F.col("noop"), "NOOP-PASS").when(F.col("hits") > 0, "LEAK-CONFIRMED").otherwise("clean")
    rows = manifest.join(leak, F.col("l.doc_id") == F.col("id"), "left").select("doc_id", F.coalesce(_ORACLES.column, F.lit("pending")).alias("oracle"), kind.alias("leak"))
    v = T.cull(F.col("oracle"), F.col("leak"))
    return rows.select("doc_id", "oracle", "leak", v["verdict"].alias("verdict"), F.array_join(v["reasons"], ";").alias("reasons"))
