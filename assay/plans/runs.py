"""Attempts, samples, joins, clusters and text functions over the driver tables, each with its SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assay.functions import text as X
from assay.operators import attempts as A
from assay.operators import clusters as C
from assay.operators import sampling as P
from assay.operators import similarity as S
from assay.plans import packages as K
from assay.plans.registry import query
from assay.plans.triage import Pick
from assay.session import ship, table, with_checkpoints

BAR = 400.0
_ERR = Pick(["", None, "AgentTimeoutError: budget", "HTTP 503", "RateLimit hit", "Authentication failed", "boom", "read timed out"], "event_id")
_TOK, _SCORE = "event_id // 3 % 5 * 1000", "CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 6 < 3 THEN 0.0 WHEN event_id % 6 < 5 THEN 1.0 ELSE 0.5 END"
RUNS_SQL = f"runs AS (SELECT event_id, event_id // 4 AS task, event_type AS model, {_ERR.sql} AS err, {_TOK} AS tokens, CAST({_SCORE} AS DOUBLE) AS score, ts, value FROM events)"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.expr("event_id div 4").alias("task"), F.col("event_type").alias("model"), _ERR.column.alias("err"), F.expr(_TOK.replace("//", "div")).alias("tokens"), F.expr(f"CAST({_SCORE} AS DOUBLE)").alias("score"), "ts", "value")


def _marks_sql(marks: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce(err, '')), '{m}')" for m in marks) + ")"


_LATE = "(contains(lower(coalesce(err, '')), 'agenttimeouterror') AND tokens > 0)"
_GENUINE = "(score IS NOT NULL AND tokens >= 2000 AND NOT (contains(coalesce(err, ''), 'Authentication') OR contains(coalesce(err, ''), 'RateLimit') OR contains(coalesce(err, ''), 'Unauthorized')))"
_REASON = f"CASE WHEN {_LATE} THEN NULL WHEN {_marks_sql(A.INFRA_MARKS)} THEN 'infra' WHEN score IS NULL THEN 'no_score' WHEN tokens = 0 AND coalesce(err, '') <> '' THEN 'zero_tok_err' END"
_VERDICT = f"CASE WHEN {_LATE} THEN 'genuine' WHEN {_marks_sql(A.RETRY_MARKS)} THEN 'retry' WHEN score IS NULL THEN 'broken' ELSE 'genuine' END"


@query(f"WITH {RUNS_SQL}, k AS (SELECT *, {_REASON} AS reason, {_VERDICT} AS verdict FROM runs) SELECT event_id, reason IS NULL AS genuine, CASE WHEN reason IS NULL THEN CASE WHEN {_LATE} THEN 0.0 ELSE score END END AS first_score, reason, verdict, CASE WHEN verdict = 'genuine' THEN CASE WHEN {_LATE} THEN 0.0 ELSE score END END AS second_score, {_GENUINE} AS long_enough FROM k")
def attempt_classes(spark, d):
    e, t, s = F.col("err"), F.col("tokens"), F.col("score")
    a, b = A.classify_attempt(e, t, s), A.triage_attempt(e, t, s)
    return _runs(spark, d).select("event_id", a["genuine"].alias("genuine"), a["score"].alias("first_score"), a["reason"].alias("reason"), b["verdict"].alias("verdict"), b["score"].alias("second_score"), A.is_genuine(e, t, s).alias("long_enough"))


@query(f"WITH {RUNS_SQL}, g AS (SELECT task, count(*) FILTER (WHERE {_GENUINE}) AS genuine FROM runs GROUP BY task), q AS (SELECT user_id * 3 AS task, count(*) AS running FROM events WHERE event_type = 'error' GROUP BY 1) SELECT coalesce(g.task, q.task) AS task, coalesce(genuine, 0) AS genuine, coalesce(running, 0) AS running, greatest(5 - coalesce(genuine, 0) - coalesce(running, 0), 0) AS need FROM g FULL JOIN q ON g.task = q.task")
def need_with_inflight(spark, d):
    running = table(spark, d, "events").where("event_type = 'error'").select((F.col("user_id") * 3).alias("task"))
    return A.need(_runs(spark, d), running, 5, A.is_genuine(F.col("err"), F.col("tokens"), F.col("score")))


_ATT = "a AS (SELECT user_id AS task, event_type AS model, json_extract_string(props, '$.k') AS chk, coalesce(value >= 400 AND NOT isnan(value), false) AS ok, event_id, value FROM events)"


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("task"), F.col("event_type").alias("model"), F.col("value").alias("score"), F.get_json_object("props", "$.k").alias("check"), "event_id")


@query(f'WITH {_ATT} SELECT task, chk AS "check" FROM a GROUP BY task, chk HAVING count(*) FILTER (WHERE ok) = 0')
def all_fail(spark, d):
    return A.failing_everywhere(_attempts(spark, d), BAR)


@query(f"WITH {_ATT} SELECT model, count(DISTINCT task) AS tasks, count(*) AS runs, count(*) FILTER (WHERE ok) AS passes FROM a GROUP BY model")
def coverage_by_model(spark, d):
    return A.coverage_by_model(_attempts(spark, d), BAR)


@query(f"WITH {_ATT}, r AS (SELECT task, round_even(avg(ok::INT), 4) AS mean FROM a GROUP BY task) SELECT mean, count(*) AS n FROM r GROUP BY mean")
def value_histogram(spark, d):
    per = _attempts(spark, d).groupBy("task").agg(F.bround(F.avg(A.is_pass(F.col("score"), BAR).cast("double")), 4).alias("mean"))
    return per.groupBy("mean").agg(F.count("*").alias("n"))


@query(f"WITH {_ATT}, f AS (SELECT DISTINCT task, chk FROM a WHERE NOT ok), p AS (SELECT CAST(doc_id AS VARCHAR) AS chk, quality FROM labels) SELECT task, f.chk AS name, CASE WHEN p.chk IS NULL THEN 'escalate-oracle' ELSE 'brittle-verifier-pattern' END AS title, quality FROM f LEFT JOIN p ON p.chk = f.chk WHERE task < 20")
def failing_checks_with_functions(spark, d):
    """Failing checks with the function that holds them, and those without one to escalate."""
    failing = _attempts(spark, d).where(~A.is_pass(F.col("score"), BAR) & (F.col("task") < 20)).select("task", F.col("check").alias("name")).distinct()
    functions = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("name"), "quality")
    found = failing.join(functions, "name").withColumn("title", F.lit("brittle-verifier-pattern"))
    lost = failing.join(functions, "name", "left_anti").withColumn("title", F.lit("escalate-oracle"))
    return found.unionByName(lost, allowMissingColumns=True).select("task", "name", "title", "quality")


@query(f"WITH {_ATT}, e AS (SELECT task, avg(ok::INT) AS mean, count(*) AS n FROM a GROUP BY task) SELECT doc_id AS task, quality AS recorded, mean, CASE WHEN mean IS NULL THEN 'unmeasured' WHEN n >= 2 AND mean > 0.2 THEN 'too-easy' ELSE 'ok' END AS verdict FROM labels LEFT JOIN e ON task = doc_id")
def recorded_vs_empirical(spark, d):
    runs = _attempts(spark, d).groupBy("task").agg(F.avg(A.is_pass(F.col("score"), BAR).cast("double")).alias("mean"), F.count("*").alias("n"))
    verdict = F.when(F.col("mean").isNull(), "unmeasured").when((F.col("n") >= 2) & (F.col("mean") > 0.2), "too-easy").otherwise("ok")
    return table(spark, d, "labels").select(F.col("doc_id").alias("task"), F.col("quality").alias("recorded")).join(runs, "task", "left").select("task", "recorded", "mean", verdict.alias("verdict"))


_CLASS = "CASE WHEN n IS NULL THEN 'none' WHEN passes = 0 THEN 'all_fail' WHEN passes = n THEN 'all_pass' ELSE 'split' END"


@query(f"WITH {_ATT}, r AS (SELECT task, count(*) AS n, count(*) FILTER (WHERE ok) AS passes, max(value) AS best FROM a GROUP BY task) SELECT lang, {_CLASS} AS kind, count(*) AS tasks, max(best) AS best FROM documents LEFT JOIN r ON task = doc_id GROUP BY ROLLUP (lang, kind)")
def split_sizes(spark, d):
    runs = _attempts(spark, d).groupBy("task").agg(F.count("*").alias("n"), F.count_if(A.is_pass(F.col("score"), BAR)).alias("passes"), F.max("score").alias("best"))
    rows = table(spark, d, "documents").select("lang", F.col("doc_id").alias("task")).join(runs, "task", "left").withColumn("kind", F.expr(_CLASS))
    return rows.rollup("lang", "kind").agg(F.count("*").alias("tasks"), F.max("best").alias("best"))


# --- samples ------------------------------------------------------------------------------------------------------
@query(f"WITH {RUNS_SQL} SELECT event_id, task FROM runs WHERE {_GENUINE} QUALIFY row_number() OVER (PARTITION BY task ORDER BY event_id) <= 1")
def first_genuine(spark, d):
    rows = _runs(spark, d).where(A.is_genuine(F.col("err"), F.col("tokens"), F.col("score")))
    return P.first_of(rows, ["task"], [F.col("event_id").asc()], 1).select("event_id", "task")


@query(f"WITH {RUNS_SQL}, k AS (SELECT *, CASE coalesce(score, 0) WHEN 0 THEN 0 WHEN 1 THEN 1 END AS kind FROM runs), r AS (SELECT *, row_number() OVER (PARTITION BY task, kind ORDER BY event_id) AS n, count(kind) OVER (PARTITION BY task) AS have FROM k) SELECT event_id, task, score FROM r WHERE n = 1 AND (kind IS NOT NULL OR have = 0)")
def one_per_outcome(spark, d):
    return P.one_per_outcome(_runs(spark, d), F.col("score"), [F.col("event_id").asc()]).select("event_id", "task", "score")


@query("WITH b AS (SELECT doc_id, CASE WHEN n_chars < 300 THEN 0 WHEN n_chars < 900 THEN 1 WHEN n_chars < 2000 THEN 2 ELSE 3 END AS band, lang = 'en' AS liked FROM documents) SELECT doc_id, band FROM b WHERE band < 3 QUALIFY row_number() OVER (PARTITION BY band ORDER BY NOT coalesce(liked, false), doc_id) <= CASE band WHEN 0 THEN 8 ELSE 6 END")
def band_quota(spark, d):
    band = F.when(F.col("n_chars") < 300, 0).when(F.col("n_chars") < 900, 1).when(F.col("n_chars") < 2000, 2).otherwise(3)
    rows = table(spark, d, "documents").select("doc_id", band.alias("band"), F.coalesce(F.col("lang") == "en", F.lit(False)).alias("liked"))
    return P.quotas(rows, "band", {0: 8, 1: 6, 2: 6}, [~F.col("liked"), F.col("doc_id").asc()]).select("doc_id", "band")


@query("WITH d AS (SELECT doc_id, coalesce(lang, '?') AS lang FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS turn, count(*) OVER (PARTITION BY lang) AS size FROM d) SELECT doc_id, lang FROM r ORDER BY turn, size, lang LIMIT 50")
def stratified_round_robin(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.coalesce("lang", F.lit("?")).alias("lang"))
    return P.round_robin(rows, "lang", [F.col("doc_id").asc()], 50)


@query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents), j AS (SELECT DISTINCT CAST(floor(k * (SELECT count(*) FROM documents) / 37) AS BIGINT) AS i FROM range(37) t(k)) SELECT doc_id FROM r JOIN j USING (i)")
def strided_sample(spark, d):
    return P.every_nth(table(spark, d, "documents").select("doc_id"), "doc_id", 37)


@query(f"WITH {RUNS_SQL}, n AS (SELECT task, greatest(3 - count(*) FILTER (WHERE {_GENUINE}), 0) AS k FROM runs GROUP BY task) SELECT task, unnest(range(1, k + 1))::INT AS copy FROM n WHERE k > 0")
def row_repetition(spark, d):
    need = A.deficits(_runs(spark, d), 3, A.is_genuine(F.col("err"), F.col("tokens"), F.col("score")))
    return P.repeated(need, F.col("deficit")).select("task", "copy")


@query("WITH s AS (SELECT doc_id, 0 AS source_rank FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 1 FROM labels UNION ALL SELECT doc_id, 2 FROM documents) SELECT doc_id, source_rank FROM s QUALIFY source_rank = min(source_rank) OVER (PARTITION BY doc_id)")
def first_source_wins(spark, d):
    labels, docs = table(spark, d, "labels"), table(spark, d, "documents")
    return P.first_source([labels.where("toxic = 1").select("doc_id"), labels.select("doc_id"), docs.select("doc_id")], ["doc_id"])


# --- joins --------------------------------------------------------------------------------------------------------
@query("SELECT doc_id, coalesce(CASE WHEN quality = 0 THEN 'rejected' END, lang) AS lang FROM documents LEFT JOIN labels USING (doc_id)")
def override_join(spark, d):
    new = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 0, "rejected").alias("lang"))
    return P.override(table(spark, d, "documents").select("doc_id", "lang"), new, "doc_id", "lang")


@query("WITH l AS (SELECT event_id AS k, CASE WHEN event_id % 2 = 0 THEN user_id END AS id, event_type AS name FROM events), r AS (SELECT user_id AS id, event_type AS name, event_id AS v FROM events WHERE event_id % 17 = 0), i AS (SELECT id, min(v) AS a FROM r GROUP BY id), n AS (SELECT name, min(v) AS b FROM r GROUP BY name) SELECT k, coalesce(a, b) AS v FROM l LEFT JOIN i USING (id) LEFT JOIN n USING (name)")
def two_key_fallback(spark, d):
    e = table(spark, d, "events")
    left = e.select(F.col("event_id").alias("k"), F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("id"), F.col("event_type").alias("name"))
    right = e.where("event_id % 17 = 0").select(F.col("user_id").alias("id"), F.col("event_type").alias("name"), F.col("event_id").alias("v"))
    return P.by_id_or_name(left, right, "id", "name", "v").select("k", "v")


@query("WITH a AS (SELECT event_type AS label, count(*) AS n FROM events WHERE event_id % 3 = 0 GROUP BY 1), b AS (SELECT event_type AS label, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1) SELECT coalesce(a.label, b.label) AS label, coalesce(a.n, 0) AS left_n, coalesce(a.n / (SELECT sum(n) FROM a), 0) AS left_share, coalesce(b.n, 0) AS right_n, coalesce(b.n / (SELECT sum(n) FROM b), 0) AS right_share FROM a FULL JOIN b ON a.label = b.label")
def side_by_side(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("label"))
    return P.side_by_side(e.where("event_id % 3 = 0").select("label"), e.where("label <> 'view'").select("label"), "label")


@query("SELECT event_id, coalesce(n_name, 'user ' || user_id) AS name FROM events LEFT JOIN nation ON n_nationkey = user_id")
def id_remap(spark, d):
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("user_id"), "n_name")
    return table(spark, d, "events").join(names, "user_id", "left").select("event_id", F.coalesce("n_name", F.concat(F.lit("user "), F.col("user_id"))).alias("name"))


_PATHS_SQL = "p AS (SELECT page_id, page_id % 20 AS task, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]{1,4})', 1) AS path FROM pages), q AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS base FROM p), baked AS (SELECT DISTINCT task, path, base FROM q WHERE page_id % 2 = 0), used AS (SELECT DISTINCT (task + 1) % 20 AS task, path, base FROM q WHERE page_id % 2 = 1), gone AS (SELECT DISTINCT task, substring(path, 1, 3) AS prefix FROM q WHERE page_id % 25 = 0)"


@query(f"WITH {_PATHS_SQL} SELECT DISTINCT b.task, b.path FROM baked b WHERE EXISTS (SELECT 1 FROM used u WHERE u.task = b.task AND (u.path = b.path OR u.base = b.base)) AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.task = b.task AND starts_with(b.path, g.prefix))")
def path_joins(spark, d):
    """Paths written and read by path or by base name, less those below a removed prefix: equal keys throughout but the prefix, which meets within a task."""
    path = F.regexp_extract("url", "^[a-z]+://[^/?#]+([^?#]{1,4})", 1)
    q = table(spark, d, "pages").select("page_id", (F.col("page_id") % 20).alias("task"), path.alias("path")).withColumn("base", F.regexp_extract("path", "([^/]*)$", 1))
    baked = q.where("page_id % 2 = 0").select("task", "path", "base").distinct()
    used = q.where("page_id % 2 = 1").select(((F.col("task") + 1) % 20).alias("task"), "path", "base").distinct()
    gone = q.where("page_id % 25 = 0").select("task", F.substring("path", 1, 3).alias("prefix")).distinct()
    hit = baked.join(used.select("task", "path"), ["task", "path"], "left_semi").unionByName(baked.join(used.select("task", "base"), ["task", "base"], "left_semi").select("task", "path", "base"))
    return hit.select("task", "path").distinct().join(gone, (hit["task"] == gone["task"]) & hit["path"].startswith(gone["prefix"]), "left_anti")


# --- distributions ------------------------------------------------------------------------------------------------
_LABELS = "list_value('l' || (event_id % 3), 'l' || (event_id % 5), 'l' || (event_id % 3))"


@query(f"WITH l AS (SELECT event_id, unnest({_LABELS}) AS label FROM events) SELECT label, count(*) AS n, count(DISTINCT event_id) AS tasks FROM l GROUP BY label")
def multi_label(spark, d):
    rows = table(spark, d, "events").select("event_id", F.expr("array('l' || (event_id % 3), 'l' || (event_id % 5), 'l' || (event_id % 3))").alias("labels"))
    every = rows.select(F.explode("labels").alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    once = rows.select(F.explode(F.array_distinct("labels")).alias("label")).groupBy("label").agg(F.count("*").alias("tasks"))
    return every.join(once, "label")


@query("WITH t AS (SELECT count(*) AS total FROM documents), c AS (SELECT lang, count(*) AS n FROM documents WHERE coalesce(lang, '') <> '' GROUP BY lang) SELECT lang, n, CASE WHEN n / total > 0.2 THEN 'category-over-represented' WHEN total >= 20 AND n / total < 0.05 THEN 'category-under-represented' ELSE 'diversity-ok' END AS title FROM c, t")
def share_floors(spark, d):
    docs = table(spark, d, "documents")
    n = docs.where("coalesce(lang, '') <> ''").groupBy("lang").agg(F.count("*").alias("n")).join(F.broadcast(docs.agg(F.count("*").alias("total"))))
    share = F.col("n") / F.col("total")
    title = F.when(share > 0.2, "category-over-represented").when((F.col("total") >= 20) & (share < 0.05), "category-under-represented").otherwise("diversity-ok")
    return n.select("lang", "n", title.alias("title"))


_COMPLAINTS = {
    "verbose": "length(coalesce(instruction, '')) // 4 > 75",
    "no_average": "NOT regexp_like(coalesce(toml, ''), r'(?m)^avg_at_8')",
    "off_eighth": "abs(round(try_cast(nullif(regexp_extract(coalesce(toml, ''), r'avg_at_8\\s*=\\s*([0-9.]+)', 1), '') AS DOUBLE) * 8) / 8 - try_cast(nullif(regexp_extract(coalesce(toml, ''), r'avg_at_8\\s*=\\s*([0-9.]+)', 1), '') AS DOUBLE)) > 1e-9",
    "delegated": "regexp_like(coalesce(test_py, ''), r'\\.truth/')",
    "installs": "regexp_like(coalesce(test_sh, ''), r'(?m)^[^#\\n]*\\b(pip3?|apt|apt-get)\\s+install\\b')",
    "encoded": "regexp_like(coalesce(test_py, ''), r'b64decode\\(\\s*[\\x27\"][A-Za-z0-9+/=]{8,1000}')",
    "shadowed": "position('pytest' IN coalesce(test_sh, '')) > 0 AND position('--noconftest' IN coalesce(test_sh, '')) = 0",
    "odd_reward": "position('reward.txt' IN coalesce(test_sh, '')) > 0 AND NOT regexp_like(coalesce(test_sh, ''), r'/logs/(tests|verifier)/reward\\.txt')",
}


@query(f"WITH {K.PACKAGES_SQL} SELECT " + ", ".join(f"count(*) FILTER (WHERE {K._duck(c)}) AS {n}" for n, c in _COMPLAINTS.items()) + " FROM packages")
def complaint_coverage(spark, d):
    return K.packages(spark, d).agg(*[F.count_if(F.expr(c.replace("//", "div"))).alias(n) for n, c in _COMPLAINTS.items()])


@query(f"WITH {RUNS_SQL} SELECT model, bool_or(score = 0) AS any_failed, count(*) FILTER (WHERE score IS NULL) AS unscored, CAST(sum(tokens) AS DOUBLE) * CAST(0.000003 AS DOUBLE) AS cost, count(*) FILTER (WHERE coalesce(score, 0) < 1) / count(*) AS killed FROM runs GROUP BY model")
def flags_cost_and_mutants(spark, d):
    return _runs(spark, d).groupBy("model").agg(F.bool_or(F.col("score") == 0).alias("any_failed"), F.count_if(F.col("score").isNull()).alias("unscored"), (F.sum("tokens").cast("double") * F.lit(0.000003)).alias("cost"), (F.count_if(F.coalesce("score", F.lit(0.0)) < 1) / F.count("*")).alias("killed"))


@query(f"WITH {RUNS_SQL} SELECT task, arg_min(err, event_id) FILTER (WHERE coalesce(err, '') <> '') AS first_error, max(CASE model WHEN 'error' THEN 3 WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END) AS worst FROM runs GROUP BY task")
def first_and_worst(spark, d):
    """The first error that says something, and the model that takes precedence."""
    said = F.coalesce("err", F.lit("")) != ""
    rank = F.when(F.col("model") == "error", 3).when(F.col("model") == "click", 2).when(F.col("model") == "view", 1).otherwise(0)
    return _runs(spark, d).groupBy("task").agg(F.min_by("err", F.when(said, F.col("event_id"))).alias("first_error"), F.max(rank).alias("worst"))


@query("SELECT event_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS recent FROM events")
def rate_window(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-6 * 3600 * 1_000_000, 0)
    return table(spark, d, "events").select("event_id", "ts", F.count("*").over(w).alias("recent"))


# --- statements ---------------------------------------------------------------------------------------------------
def _statement(text: str):
    def run(spark, d):
        # frames are named in the statement alone, so the session's views stay as they are
        named = {name: table(spark, d, name) for name in ("events", "documents", "labels") if f"{{t}}{name}" in text}
        return spark.sql(re.sub(r"\{t\}(\w+)", r"{\1}", text), **named)

    return run


for _name, _text in {
    "sql_batches": "SELECT event_type AS batch, count(*) AS n FROM {t}events GROUP BY 1 ORDER BY n DESC, batch LIMIT 3",
    "sql_ilike": "SELECT event_id FROM {t}events WHERE event_type ILIKE '%LI%' AND NOT event_type ILIKE 'p%'",
    "sql_inflight": "SELECT user_id, count(*) AS n FROM {t}events WHERE event_type IN ('error', 'view') GROUP BY user_id",
    "sql_latest_of_one": "SELECT event_id, value FROM {t}events WHERE user_id = 7 ORDER BY ts DESC LIMIT 60",
    "sql_flagged": "SELECT doc_id FROM {t}labels WHERE quality = 0 AND toxic = 1",
    "sql_by_world": "SELECT doc_id FROM {t}documents WHERE source = 'src1'",
    "sql_semi": "SELECT doc_id, lang FROM {t}documents WHERE doc_id IN (SELECT doc_id FROM {t}labels WHERE toxic = 1)",
}.items():
    _f = _statement(_text)
    _f.__name__ = _name
    query(_text.replace("{t}", ""))(_f)


# --- text and clusters --------------------------------------------------------------------------------------------
@query("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents) SELECT doc_id, line_no::INT AS line_no, line FROM l WHERE regexp_matches(line, '[0-9]{3}') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY line_no) = 1")
def first_match_per_task(spark, d):
    lines = table(spark, d, "documents").select("doc_id", X.numbered_lines(F.col("text")).alias("l")).select("doc_id", F.explode("l").alias("l")).where(F.col("l.line").rlike("[0-9]{3}"))
    first = lines.groupBy("doc_id").agg(F.min(F.struct("l.line_no", "l.line")).alias("m"))
    return first.select("doc_id", "m.line_no", "m.line")


# stand-ins for the vocabulary, from the language of the documents
_TECH, _OPS = ("erin", "anea", "thor", "thre", "leau", "sich", "ndun", "aux", "ción", "heit", "chen", "amento", "qu", "ver"), ("thou", "eron", "ment", "ung")
_SEED = ("eaux", "ción", "heit", "thon")


def _print_sql() -> str:
    words = [(w, w) for w in _TECH] + [(w, f"op:{w}") for w in _OPS]
    return "list_filter([" + ", ".join(f"CASE WHEN contains(lower(coalesce(text, '')), '{w}') THEN '{n}' END" for w, n in words) + "], lambda x: x IS NOT NULL)"


CLUSTER_SQL = f"""t AS (SELECT doc_id AS task, unnest({_print_sql()}) AS token FROM documents),
rare AS (SELECT token FROM t GROUP BY token HAVING count(*) / (SELECT count(*) FROM documents) < 0.35),
k AS (SELECT task, token FROM t WHERE token IN (SELECT token FROM rare)),
sets AS (SELECT task, list_sort(list(token)) AS s FROM k GROUP BY task),
pairs AS (SELECT a.task AS u, b.task AS v FROM sets a JOIN sets b ON a.task <> b.task AND len(a.s) >= 2 AND len(b.s) >= 2 AND len(list_intersect(a.s, b.s)) >= 0.6 * (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) - 1e-9)"""


@query(f"WITH RECURSIVE {CLUSTER_SQL}, reach AS (SELECT DISTINCT u AS id, u AS spot FROM pairs UNION SELECT id, v FROM reach JOIN pairs ON u = spot), c AS (SELECT id, min(spot) AS component FROM reach GROUP BY id), z AS (SELECT component, count(*) AS size FROM c GROUP BY component HAVING count(*) >= 8), h AS (SELECT component, token, count(*) AS n FROM c JOIN k ON task = id GROUP BY ALL) SELECT z.component, size, coalesce((SELECT array_to_string(list_slice(list_sort(list(token)), 1, 8), ', ') FROM h WHERE h.component = z.component AND n / size >= 0.7), '') AS common FROM z")
def clusters(spark, d):
    with_checkpoints(spark)
    # a table may be one row group, which one task reads; the words are looked up by as many as there are cores, once
    docs = table(ship(spark), d, "documents").select(F.col("doc_id").alias("task"), "text").repartition("task")
    prints = docs.select("task", C.fingerprint(F.col("text"), _TECH, _OPS).alias("tokens")).checkpoint()
    tokens = C.distinctive(prints).checkpoint()
    return C.described(tokens, C.components(C.alike(tokens, 0.6, (*_TECH, *(f"op:{w}" for w in _OPS)))), 8)


_SIG_SQL = "coalesce(" + ", ".join(f"CASE WHEN contains(lower(coalesce(text, '')), '{s}') THEN '{s}' END" for s in _SEED) + ", '?')"


@query(f"WITH s AS (SELECT {_SIG_SQL} AS seed FROM documents), n AS (SELECT seed, count(*) AS n FROM s WHERE seed <> '?' GROUP BY seed) SELECT seed, n FROM n WHERE n / (SELECT count(*) FROM documents) > 0.05")
def seeds_over(spark, d):
    docs = table(spark, d, "documents")
    n = docs.groupBy(C.seed_signature(F.col("text"), _SEED)["seed"].alias("seed")).agg(F.count("*").alias("n")).where("seed <> '?'")
    return n.join(F.broadcast(docs.agg(F.count("*").alias("total")))).where(F.col("n") / F.col("total") > 0.05).select("seed", "n")


_NAMES = Pick(["fix-ledger-0a1b2c3d", "fix-the-ledger", "rotate-keys-in-vault", "merge-two-logs", "abcdef12"], "event_id")


@query(f"WITH w AS (SELECT event_id, unnest(list_distinct(list_filter(string_split(regexp_replace({_NAMES.sql}, '(^|-)[0-9a-f]{{6,}}$', ''), '-'), lambda x: length(x) >= 3 AND x <> 'the'))) AS word FROM events) SELECT word, count(*) AS n FROM w GROUP BY word HAVING count(*) > 0.05 * (SELECT count(*) FROM events)")
def name_words_over(spark, d):
    e = table(spark, d, "events").select(C.name_tokens(_NAMES.column, ("the",)).alias("w"))
    n = e.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(e.agg(F.count("*").alias("total")))).where(F.col("n") > 0.05 * F.col("total")).select("word", "n")


@query("SELECT source, doc_id % 50 AS name, arg_min(trim(regexp_replace(text, '\\s+', ' ', 'g')), doc_id) AS text FROM documents WHERE text IS NOT NULL GROUP BY ALL")
def corpus_build(spark, d):
    rows = table(spark, d, "documents").where("text is not null").select("source", (F.col("doc_id") % 50).alias("name"), "text", F.col("doc_id").alias("place"))
    return C.corpus(rows)


@query("WITH q AS (SELECT vec_id AS a, embedding AS x FROM embeddings WHERE vec_id % 50 = 0), p AS (SELECT a, vec_id AS b, list_cosine_similarity(x::DOUBLE[], embedding::DOUBLE[]) AS s FROM q JOIN embeddings ON vec_id <> a) SELECT a AS query_id, b AS vec_id, round(s, 6) AS score FROM p QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(s, 9) DESC, b) = 1")
def dense_best_match(spark, d):
    e = table(ship(spark), d, "embeddings")
    return S.dense_best(e.where("vec_id % 50 = 0"), e).select("query_id", "vec_id", F.round("score", 6).alias("score"))


_TAGS = Pick(["rust,python", "c++,web", "flask,csv", "tokio", "data-science", "misc", "Golang", "scipy", "keras,web", "fastify", "data-pipeline", "socket.io,gin"], "event_id")


@query(f"WITH t AS (SELECT event_id, string_split(lower({_TAGS.sql}), ',') AS tags FROM events) SELECT event_id, CASE WHEN list_contains(tags, 'python') THEN 'python' WHEN list_contains(tags, 'rust') THEN 'rust' WHEN list_contains(tags, 'golang') THEN 'go' WHEN list_contains(tags, 'c++') THEN 'cpp' WHEN list_has_any(tags, ['flask', 'scipy', 'keras']) THEN 'python' WHEN list_has_any(tags, ['fastify', 'socket.io']) THEN 'javascript' WHEN list_contains(tags, 'tokio') THEN 'rust' WHEN list_has_any(tags, ['data-science', 'data-pipeline']) THEN 'python' ELSE 'unknown' END AS language FROM t")
def language_of_tags(spark, d):
    return table(spark, d, "events").select("event_id", X.language_of_tags(F.split(_TAGS.column, ",")).alias("language"))


_STOP_TOKENS = ", ".join(f"'{w}'" for w in X.GENERIC_TOKENS)


@query(rf"""WITH {K.PACKAGES_SQL}, q AS (SELECT task, dockerfile, list_transform(regexp_extract_all(coalesce(test_py, ''), '"[^"\n]*"|\x27[^\x27\n]*\x27'), lambda x: trim(x[2:-2])) AS quoted, regexp_extract_all(coalesce(test_py, ''), '\b([0-9a-fA-F]{{12,}}|[0-9]{{4,}})\b') AS numbers FROM packages),
u AS (SELECT task, coalesce(dockerfile, '') AS seen, list_distinct(list_concat(list_filter(quoted, lambda x: length(x) >= 8 AND NOT regexp_matches(x, '^(/|http|test_|[{{]|%)') AND lower(x) NOT IN ({_STOP_TOKENS}) AND regexp_matches(x, '[A-Za-z0-9]')), numbers)) AS tokens FROM q)
SELECT task, least(len(tokens), 60)::INT AS tokens, len(list_filter(list_sort(list_transform(tokens, lambda x: {{'n': -length(x), 'x': x}}))[1:60], lambda p: contains(seen, p.x)))::INT AS hits FROM u""")
def expected_token_leak(spark, d):
    """Tokens of the tests, and those that files other than tests, solution, metadata and instruction show."""
    tokens = K.packages(spark, d).select("task", X.expected_tokens(F.col("test_py")).alias("t"), F.coalesce("dockerfile", F.lit("")).alias("seen"))
    return tokens.select("task", F.size("t").alias("tokens"), F.size(F.filter("t", lambda x: F.col("seen").contains(x))).alias("hits"))


# --- attempts as they come ----------------------------------------------------------------------------------------
_COME = """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN 'Completed' WHEN 'click' THEN NULL ELSE event_type END AS status, CASE WHEN value < 5 THEN '' ELSE event_type END AS task_name, user_id AS task_id FROM {e}"""


@query(f"WITH a AS ({_COME.format(e='events')}) SELECT CASE WHEN task_name IS NULL OR task_name = '' THEN CAST(task_id AS VARCHAR) ELSE task_name END AS task, count(*) AS n FROM a WHERE status = 'completed' GROUP BY 1")
def completed_by_key(spark, d):
    attempts = spark.sql(_COME.format(e="{e}"), e=table(spark, d, "events"))
    return A.completed(attempts).groupBy(A.task_key().alias("task")).agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n FROM documents WHERE source IN ('src1', 'src3') GROUP BY source")
def only_listed(spark, d):
    return A.only(table(spark, d, "documents"), "src1,,src3", "source").groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT doc_id FROM documents WHERE source = 'src1' UNION SELECT doc_id FROM labels WHERE quality = 0")
def union_of_ids(spark, d):
    labels = table(spark, d, "labels")
    return A.distinct_ids([labels.where("toxic = 1"), table(spark, d, "documents").where("source = 'src1'"), labels.where("quality = 0")], "doc_id")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x FROM documents), n AS (SELECT doc_id, 'test_' || regexp_extract(x, '[a-z]+') || '_' || length(x) % 2 AS name FROM l WHERE length(x) % 3 = 0)
SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS failed FROM n GROUP BY doc_id""")
def failed_test_names(spark, d):
    """Names from logs, with a line for each line of a document."""
    line = lambda x: F.concat(F.lit("tests/test_outputs.py::test_"), F.regexp_extract(x, "([a-z]+)", 1), F.lit("_"), (F.length(x) % 2).cast("string"), F.when(F.length(x) % 3 == 0, " FAILED").otherwise(" PASSED"), F.lit(" [ 3%]"))
    log = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line), "\n")
    return table(spark, d, "documents").select("doc_id", F.array_join(A.failed_tests(log), ",").alias("failed")).where("failed <> ''")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND x > 0.9 THEN NULL WHEN x BETWEEN 0 AND 1 THEN round_even(x * 8, 0) / 8 ELSE x END AS avg_at_8 FROM (SELECT *, o_totalprice % 128 / 100 AS x FROM orders)")
def promoted_metadata(spark, d):
    """The canonical key of half the orders, an alias of the others, neither for a few."""
    x = F.col("o_totalprice") % 128 / 100
    name = F.when(F.col("o_orderstatus") != "O", "avg_at_8").when(x <= 0.9, "avg-at-8").otherwise("other")
    meta = A.promoted(F.create_map(name, x), {"avg_at_8": "avg-at-8"})
    return table(spark, d, "orders").select("o_orderkey", A.nearest_eighth(meta["avg_at_8"]).alias("avg_at_8"))
