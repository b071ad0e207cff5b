"""All registered queries of the reference's operators over the driver tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import attempts as A
from assay.operators import findings as N
from assay.operators import similarity as S
from assay.plans.registry import ORACLES, QUERIES, query  # noqa: F401
from assay.session import ship, table

MODELS = ("click", "login", "purchase", "signup", "view")
BAR = 50.0


# --- findings -----------------------------------------------------------------------------------------------------
def _findings(spark: SparkSession, d: str) -> DataFrame:
    return N.text_findings(table(spark, d, "documents"))


def _kept(spark: SparkSession, d: str) -> DataFrame:
    """Findings less the e-mail findings of documents labelled good, which stand for refuted ones."""
    refuted = table(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("task"), F.lit("email-address").alias("title"))
    return N.reconcile(_findings(spark, d), refuted)


def _layer_sql(area: str) -> str:
    return f"CASE WHEN {area} IN ('anti_cheat', 'solution') THEN 'semantic' WHEN {area} = 'behavioral' THEN 'behavioral' ELSE 'static' END"


_HITS = " UNION ALL ".join(f"SELECT doc_id AS task, '{r.area}' AS area, '{r.severity}' AS severity, '{r.title}' AS title FROM documents WHERE regexp_matches(text, '{r.pattern}')" for r in N.TEXT_RULES)
FINDINGS_SQL = f"hits AS ({_HITS}), findings AS (SELECT *, {_layer_sql('area')} AS layer FROM hits UNION ALL SELECT doc_id, 'structure', 'PASS', 'clean', 'static' FROM documents WHERE doc_id NOT IN (SELECT task FROM hits))"
KEPT_SQL = f"{FINDINGS_SQL}, kept AS (SELECT f.* FROM findings f WHERE NOT (title = 'email-address' AND task IN (SELECT doc_id FROM labels WHERE quality = 1)))"
_RANK = "CASE severity WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END"


def _sev_sql(x: str) -> str:
    return f"CASE {x} WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' WHEN 0 THEN 'PASS' END"


_AREA_COLS = ", ".join(_sev_sql(f"max(CASE WHEN area = '{a}' THEN {_RANK} END)") + f" AS {a}" for a in N.AREAS)
VERDICT_SQL = f"{KEPT_SQL}, verdicts AS (SELECT task, {_AREA_COLS}, {_sev_sql(f'max({_RANK})')} AS overall, coalesce(string_agg(DISTINCT CASE WHEN severity = 'FAIL' THEN title END, '; ' ORDER BY CASE WHEN severity = 'FAIL' THEN title END), '') AS critical_issues FROM kept GROUP BY task)"


@query(f"WITH {VERDICT_SQL}, c AS (SELECT count(*) FILTER (WHERE overall = 'FAIL' AND quality = 0) AS tp, count(*) FILTER (WHERE overall = 'FAIL' AND quality <> 0) AS fp, count(*) FILTER (WHERE overall <> 'FAIL' AND quality = 0) AS fn, count(*) FILTER (WHERE overall <> 'FAIL' AND quality <> 0) AS tn FROM verdicts JOIN labels ON task = doc_id) SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM c")
def gate_scorecard(spark, d):
    flagged = N.verdicts(_kept(spark, d)).select("task", (F.col("overall") == "FAIL").alias("flagged"))
    return N.scorecard(flagged, table(spark, d, "labels").select(F.col("doc_id").alias("task"), (F.col("quality") == 0).alias("is_defect")))


@query(f"WITH {FINDINGS_SQL} SELECT * FROM findings")
def findings_from_docs(spark, d):
    return _findings(spark, d)


@query(f"WITH {KEPT_SQL} SELECT * FROM kept")
def reconcile_refuted(spark, d):
    return _kept(spark, d)


@query(f"WITH {VERDICT_SQL} SELECT * FROM verdicts")
def verdict_pivot(spark, d):
    return N.verdicts(_kept(spark, d))


_BAD = "severity = 'FAIL'"
GATE_SQL = f"{KEPT_SQL}, gated AS (SELECT task, NOT bool_or({_BAD}) AS promoted, coalesce(string_agg(DISTINCT CASE WHEN {_BAD} THEN layer END, ',' ORDER BY CASE WHEN {_BAD} THEN layer END), '') AS layers, coalesce(string_agg(DISTINCT CASE WHEN {_BAD} THEN title END, ',' ORDER BY CASE WHEN {_BAD} THEN title END), '') AS titles FROM kept GROUP BY task)"


@query(f"WITH {GATE_SQL} SELECT * FROM gated")
def gate_partition(spark, d):
    return N.gate(_kept(spark, d))


@query(f"WITH {KEPT_SQL} SELECT layer, count(DISTINCT task) AS tasks FROM kept WHERE {_BAD} GROUP BY layer")
def quarantine_by_layer(spark, d):
    return _kept(spark, d).where("severity = 'FAIL'").groupBy("layer").agg(F.count_distinct("task").alias("tasks"))


@query(f"WITH {KEPT_SQL} SELECT t.task, a.area FROM (SELECT DISTINCT task FROM kept) t, (SELECT unnest([{', '.join(repr(a) for a in N.AREAS)}]) AS area) a WHERE (t.task, a.area) NOT IN (SELECT (task, area) FROM kept)")
def coverage_gaps(spark, d):
    return N.coverage_gaps(_kept(spark, d))


@query(f"WITH {KEPT_SQL} SELECT area, title, count(*) AS n FROM kept WHERE {_BAD} GROUP BY GROUPING SETS ((area), (area, title), ())")
def defect_distribution(spark, d):
    return N.distribution(_kept(spark, d))


@query(f"WITH {VERDICT_SQL} SELECT CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN v.task IS NULL THEN 'unpredicted' ELSE 'both' END AS side, count(*) AS n FROM verdicts v FULL JOIN labels l ON v.task = l.doc_id GROUP BY 1")
def score_remainders(spark, d):
    v, lab = N.verdicts(_kept(spark, d)).select("task"), table(spark, d, "labels").select("doc_id")
    side = F.when(F.col("doc_id").isNull(), "unlabelled").when(F.col("task").isNull(), "unpredicted").otherwise("both")
    return v.join(lab, v["task"] == lab["doc_id"], "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@query(f"WITH {KEPT_SQL} SELECT title, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM kept GROUP BY title ORDER BY n DESC, title LIMIT 5")
def top_titles(spark, d):
    n = _kept(spark, d).groupBy("title").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).orderBy(F.desc("n"), "title").limit(5)


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) SELECT doc_id, lang, source FROM r WHERE k = 1")
def dedup_first(spark, d):
    docs = table(spark, d, "documents")
    first = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min_by(F.struct("doc_id", "lang", "source"), "doc_id").alias("x"))
    return first.select("x.*")


@query(f"WITH {FINDINGS_SQL} SELECT task, {_sev_sql(f'max({_RANK})')} AS severity FROM findings GROUP BY task")
def keep_worst(spark, d):
    return _findings(spark, d).groupBy("task").agg(N.severity(F.max(N.rank(F.col("severity")))).alias("severity"))


# --- similarity ---------------------------------------------------------------------------------------------------
_STOP = ", ".join(f"'{w}'" for w in S.STOPWORDS)


def _toks_sql(t: str, key: str) -> str:
    return f"SELECT {key}, list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: length(x) > 1 AND x NOT IN ({_STOP})) AS t FROM {t}"


def _tfidf_sql() -> str:
    return f"""dt AS ({_toks_sql('documents', 'doc_id')}), bt AS ({_toks_sql('benchmark', 'item_id')}),
dc AS (SELECT doc_id, term, count(*) AS n, any_value(total) AS total FROM (SELECT doc_id, len(t) AS total, unnest(t) AS term FROM dt) GROUP BY ALL),
bc AS (SELECT item_id, term, count(*) AS n, any_value(total) AS total FROM (SELECT item_id, len(t) AS total, unnest(t) AS term FROM bt) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM (SELECT term FROM dc UNION ALL SELECT term FROM bc) GROUP BY term),
w AS (SELECT term, ln((1 + (SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark)) / (1 + df)) + 1 AS idf FROM df),
dv AS (SELECT doc_id, term, n / total * idf AS w FROM dc JOIN w USING (term)), bv AS (SELECT item_id, term, n / total * idf AS w FROM bc JOIN w USING (term)),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM dv GROUP BY doc_id), bn AS (SELECT item_id, sqrt(sum(w * w)) AS norm FROM bv GROUP BY item_id),
dots AS (SELECT doc_id, item_id, sum(dv.w / dn.norm * bv.w / bn.norm) AS score FROM dv JOIN dn USING (doc_id) JOIN bv USING (term) JOIN bn USING (item_id) GROUP BY ALL),
best AS (SELECT d.doc_id, m.item_id, coalesce(m.score, 0) AS score FROM documents d LEFT JOIN (SELECT * FROM dots QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, item_id) = 1) m USING (doc_id))"""


@query(f"SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct FROM ({_toks_sql('documents', 'doc_id')})")
def tokens_per_doc(spark, d):
    t = S.tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


@query(f"WITH {_tfidf_sql()} SELECT item_id, term, round(w, 6) AS w FROM bv")
def tfidf_terms(spark, d):
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    a, b = S.term_counts(docs, "doc_id"), S.term_counts(items, "item_id")
    return S.weighted(b, S.idf([a, b], S.n_rows(docs, items)), "item_id").select("item_id", "term", F.round("w", 6).alias("w"))


@query(f"WITH {_tfidf_sql()} SELECT doc_id, item_id, round(score, 6) AS score FROM best")
def contamination_best(spark, d):
    return S.best_match(table(ship(spark), d, "documents"), table(spark, d, "benchmark")).select("doc_id", "item_id", F.round("score", 6).alias("score"))


@query(f"WITH {_tfidf_sql()} SELECT CASE WHEN score >= 0.7 THEN 'FAIL' WHEN score >= 0.5 THEN 'WARN' ELSE 'PASS' END AS verdict, count(*) AS n FROM best GROUP BY 1")
def contamination_verdict(spark, d):
    return S.best_match(table(ship(spark), d, "documents"), table(spark, d, "benchmark")).groupBy(S.verdict(F.col("score")).alias("verdict")).agg(F.count("*").alias("n"))


def _near_sql(t: float) -> str:
    return f"""WITH m AS (SELECT doc_id, text, md5(coalesce(text, '')) AS h FROM documents),
one AS (SELECT h, min(doc_id) AS doc_id, count(*) AS copies, any_value(text) AS text FROM m GROUP BY h), toks AS ({_toks_sql('one', 'doc_id, copies')}),
c AS (SELECT doc_id, copies, term, count(*) AS n, any_value(total) AS total FROM (SELECT doc_id, copies, len(t) AS total, unnest(t) AS term FROM toks) GROUP BY ALL),
w AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + sum(copies))) + 1 AS idf FROM c GROUP BY term),
v AS (SELECT doc_id, term, n / total * idf AS w FROM c JOIN w USING (term)), n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM v GROUP BY doc_id),
u AS (SELECT doc_id, term, w / norm AS w FROM v JOIN n USING (doc_id))
SELECT x.doc_id AS a, y.doc_id AS b, 'near' AS kind FROM u x JOIN u y ON x.term = y.term AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id HAVING sum(x.w * y.w) >= {t}
UNION ALL SELECT one.doc_id, m.doc_id, 'copy' FROM m JOIN one USING (h) WHERE one.doc_id <> m.doc_id"""


@query(_near_sql(0.6))
def near_dup_pairs(spark, d):
    return S.near_duplicates(table(ship(spark), d, "documents"), 0.6)


@query(_near_sql(0.9))
def near_dup_strict(spark, d):
    return S.near_duplicates(table(ship(spark), d, "documents"), 0.9)


@query(f"WITH s AS (SELECT item_id, list_distinct(t) AS s FROM ({_toks_sql('benchmark', 'item_id')}) WHERE len(list_distinct(t)) >= 2), p AS (SELECT x.item_id AS a, y.item_id AS b, len(list_intersect(x.s, y.s)) AS n, len(x.s) + len(y.s) AS m FROM s x JOIN s y ON x.item_id < y.item_id) SELECT a, b, n / (m - n) AS jaccard FROM p WHERE n / (m - n) >= 0.1")
def jaccard_pairs(spark, d):
    return S.jaccard_pairs(table(spark, d, "benchmark"), "item_id", 0.1)


@query("SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) >= 0.4")
def dense_near_dup(spark, d):
    return S.dense_near_duplicates(table(ship(spark), d, "embeddings"), 0.4)


@query("WITH w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(substring(text, 1, 400)), '[a-z][a-z0-9-]{3,}'))) AS word FROM documents) SELECT word, count(*) AS docs FROM w GROUP BY word HAVING count(*) > 0.05 * (SELECT count(*) FROM documents)")
def scenario_words_over(spark, d):
    docs = table(spark, d, "documents")
    words = docs.select(F.explode(S.scenario_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    return words.join(F.broadcast(S.n_rows(docs))).where(F.col("docs") > 0.05 * F.col("n")).select("word", "docs")


# --- distributions ------------------------------------------------------------------------------------------------
def _share(spark, d, col: str) -> DataFrame:
    docs = table(spark, d, "documents")
    n = docs.groupBy(col).agg(F.count("*").alias("n")).join(F.broadcast(S.n_rows(docs).withColumnRenamed("n", "total")))
    return n.select(col, "n", (F.col("n") / F.col("total")).alias("share"), (F.col("n") / F.col("total") > 0.2).alias("over_cap"))


@query("SELECT lang, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS share, count(*) / (SELECT count(*) FROM documents) > 0.2 AS over_cap FROM documents GROUP BY lang")
def category_share(spark, d):
    return _share(spark, d, "lang")


@query("SELECT source, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS share, count(*) / (SELECT count(*) FROM documents) > 0.2 AS over_cap FROM documents GROUP BY source")
def source_share(spark, d):
    return _share(spark, d, "source")


@query("SELECT lang, CASE WHEN n_chars < 400 THEN 'short' WHEN n_chars < 1200 THEN 'medium' ELSE 'long' END AS bucket, count(*) AS n, median(n_chars) AS median_chars FROM documents GROUP BY ALL")
def length_buckets(spark, d):
    b = F.when(F.col("n_chars") < 400, "short").when(F.col("n_chars") < 1200, "medium").otherwise("long")
    return table(spark, d, "documents").groupBy("lang", b.alias("bucket")).agg(F.count("*").alias("n"), F.median("n_chars").alias("median_chars"))


@query("SELECT t.label FROM (SELECT unnest(['click', 'view', 'purchase', 'refund', 'share']) AS label) t WHERE t.label NOT IN (SELECT event_type FROM events)")
def taxonomy_missing(spark, d):
    have = table(spark, d, "events").select(F.col("event_type").alias("label")).distinct()
    wanted = spark.range(1).select(F.explode(F.array(*map(F.lit, ("click", "view", "purchase", "refund", "share")))).alias("label"))
    return wanted.join(have, "label", "left_anti")


@query("SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 40")
def md5_sample(spark, d):
    return table(spark, d, "documents").select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(40)


# --- attempts: user = task, event type = model, value = score ------------------------------------------------------
def _attempts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("task"), F.col("event_type").alias("model"), F.col("value").alias("score"), F.get_json_object("props", "$.k").alias("check"), "ts", F.col("event_id").alias("attempt"))


_ATT = "WITH a AS (SELECT user_id AS task, event_type AS model, value AS score, json_extract_string(props, '$.k') AS chk, ts, event_id AS attempt, coalesce(value >= 50 AND NOT isnan(value), false) AS ok FROM events)"


@query(f"{_ATT} SELECT task, count(*) AS n, count(*) FILTER (WHERE ok) AS passes, string_agg(DISTINCT model, ',' ORDER BY model) AS models, count(*) FILTER (WHERE ok) / count(*) AS rate, CASE WHEN count(*) FILTER (WHERE ok) = 0 THEN 'all_fail' WHEN count(*) FILTER (WHERE ok) = count(*) THEN 'all_pass' ELSE 'split' END AS kind FROM a GROUP BY task")
def split_score(spark, d):
    return A.task_rates(_attempts(spark, d), BAR)


@query(f'{_ATT} SELECT task, chk AS "check", count(*) AS total, count(*) FILTER (WHERE NOT ok) AS fails, count(DISTINCT CASE WHEN NOT ok THEN model END) AS failing_models FROM a GROUP BY task, chk')
def check_failure_rate(spark, d):
    return A.check_failures(_attempts(spark, d), BAR)


@query(f"{_ATT}, g AS (SELECT task, model, count(*) AS n, avg(ok::INT) AS rate, min(attempt) AS seen FROM a GROUP BY task, model) SELECT task, model, n, rate, CASE WHEN rate <= 0.125 THEN 'very_hard' WHEN rate <= 0.25 THEN 'hard' WHEN rate <= 0.5 THEN 'medium' ELSE 'easy' END AS band FROM g QUALIFY row_number() OVER (PARTITION BY task ORDER BY model IN ('purchase', 'signup') DESC, n DESC, seen) = 1")
def difficulty_argmax(spark, d):
    return A.empirical_difficulty(_attempts(spark, d), ("purchase", "signup"), BAR)


@query(f"{_ATT} SELECT task, model, count(*) AS n, avg(ok::INT) AS rate FROM a GROUP BY task, model")
def passrate_long(spark, d):
    return _attempts(spark, d).groupBy("task", "model").agg(F.count("*").alias("n"), F.avg(A.is_pass(F.col("score"), BAR).cast("double")).alias("rate"))


_WIDE = ", ".join(f"avg(CASE WHEN model = '{m}' THEN ok::INT END) AS {m}" for m in MODELS)


@query(f"{_ATT}, w AS (SELECT task, {_WIDE} FROM a GROUP BY task) SELECT *, list_avg([{', '.join(MODELS)}]) AS mean_rate FROM w")
def passrate_wide(spark, d):
    return A.rates_wide(_attempts(spark, d), MODELS, BAR)


@query(f"{_ATT}, w AS (SELECT task, {_WIDE} FROM a GROUP BY task) SELECT count(*) FILTER (WHERE click <= 0.5) AS hard_click, count(*) FILTER (WHERE view <= 0.5) AS hard_view, count(*) FILTER (WHERE click <= 0.5 OR view <= 0.5) AS hard_either, count(*) FILTER (WHERE click <= 0.5 AND view <= 0.5) AS hard_both FROM w")
def hard_either_both(spark, d):
    a, b = F.col("click") <= 0.5, F.col("view") <= 0.5
    w = A.rates_wide(_attempts(spark, d), MODELS, BAR)
    return w.agg(F.count_if(a).alias("hard_click"), F.count_if(b).alias("hard_view"), F.count_if(a | b).alias("hard_either"), F.count_if(a & b).alias("hard_both"))


@query(f"{_ATT} SELECT task, count(*) FILTER (WHERE score >= 5) AS genuine, greatest(20 - count(*) FILTER (WHERE score >= 5), 0) AS deficit FROM a GROUP BY task")
def topup_deficit(spark, d):
    return A.deficits(_attempts(spark, d), 20, F.col("score") >= 5)


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, d):
    return A.latest(table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("WITH m AS (SELECT min(ts) + INTERVAL 15 DAY AS cut FROM events), n AS (SELECT * FROM events WHERE ts >= (SELECT cut FROM m)) SELECT event_id, user_id, event_type FROM n UNION ALL SELECT event_id, user_id, event_type FROM events e WHERE ts < (SELECT cut FROM m) AND NOT EXISTS (SELECT 1 FROM n WHERE n.user_id = e.user_id AND n.event_type = e.event_type)")
def supersede_union(spark, d):
    e = table(spark, d, "events")
    cut = e.agg((F.min("ts") + F.expr("INTERVAL 15 DAY")).alias("cut")).first()["cut"]
    cols = ["event_id", "user_id", "event_type"]
    return N.supersede(e.where(F.col("ts") < F.lit(cut)).select(*cols), e.where(F.col("ts") >= F.lit(cut)).select(*cols), ["user_id", "event_type"])


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    w = F.window("ts", "1 day")
    return table(spark, d, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, fresh DESC ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS started, count(*) AS n FROM s GROUP BY user_id, k")
def event_sessions(spark, d):
    s = F.session_window("ts", "6 hours")
    return table(spark, d, "events").groupBy("user_id", s.alias("s")).agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("started"), "n")


# --- conversations, pages ------------------------------------------------------------------------------------------
@query("SELECT conv_id, turn, count(*) FILTER (WHERE role = 'assistant') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS seen FROM conversations")
def lookback_window(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-6, 0)
    return table(spark, d, "conversations").select("conv_id", "turn", F.count_if(F.col("role") == "assistant").over(w).alias("seen"))


@query("SELECT conv_id, bool_or(role = 'assistant' AND trim(text) <> '') AS answered FROM conversations GROUP BY conv_id")
def conv_noop(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.bool_or((F.col("role") == "assistant") & (F.trim("text") != "")).alias("answered"))


@query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, count(*) AS pages, count(*) FILTER (WHERE regexp_matches(html, '<script')) AS scripted FROM pages GROUP BY 1")
def html_fetch_hosts(spark, d):
    return table(spark, d, "pages").groupBy(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host")).agg(F.count("*").alias("pages"), F.count_if(F.col("html").contains("<script")).alias("scripted"))


# --- relational shapes over the star schema ------------------------------------------------------------------------
@query("SELECT n_name, r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def star_join(spark, d):
    t = {n: table(spark, d, n) for n in ("orders", "customer", "nation", "region")}
    j = t["orders"].join(t["customer"], F.expr("o_custkey = c_custkey")).join(t["nation"], F.expr("c_nationkey = n_nationkey")).join(t["region"], F.expr("n_regionkey = r_regionkey"))
    return j.groupBy("n_name", "r_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT c_mktsegment, count(*) AS idle FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) GROUP BY c_mktsegment")
def star_anti(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_totalprice > 400000"), F.expr("o_custkey = c_custkey"), "left_anti").groupBy("c_mktsegment").agg(F.count("*").alias("idle"))


@query("SELECT count(*) AS n FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def star_semi(spark, d):
    return table(spark, d, "part").join(table(spark, d, "lineitem").where("l_quantity >= 49"), F.expr("p_partkey = l_partkey"), "left_semi").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def star_rollup(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def star_cube(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def star_topk(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("(SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def star_setops(spark, d):
    def by(s: str) -> DataFrame:
        return table(spark, d, "orders").where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))

    return by("F").intersect(by("O")).subtract(by("P"))


# the other modules register theirs
from assay.plans import files, packages, reviews, runs, static_qc, triage  # noqa: E402, F401
