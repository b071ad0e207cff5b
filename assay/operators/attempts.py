"""Attempts: pass rates, splits, failing checks, difficulty, deficits. Columns: task, model, score, check, ts, attempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_pass(score: Column, bar: float = 1.0) -> Column:
    """score >= bar; null and NaN fail (Spark would order NaN above all numbers)."""
    s = F.coalesce(score, F.lit(float("-inf")))
    return (s >= bar) & ~F.isnan(s)


def task_rates(attempts: DataFrame, bar: float = 1.0) -> DataFrame:
    """Attempts, passes, rate, models and class (all_fail, split, all_pass) of each task."""
    n = attempts.groupBy("task").agg(F.count("*").alias("n"), F.count_if(is_pass(F.col("score"), bar)).alias("passes"), F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models"))
    kind = F.when(F.col("passes") == 0, "all_fail").when(F.col("passes") == F.col("n"), "all_pass").otherwise("split")
    return n.withColumn("rate", F.col("passes") / F.col("n")).withColumn("kind", kind)


def check_failures(attempts: DataFrame, bar: float = 1.0) -> DataFrame:
    """(task, check) total, fails and distinct failing models."""
    bad = ~is_pass(F.col("score"), bar)
    return attempts.groupBy("task", "check").agg(F.count("*").alias("total"), F.count_if(bad).alias("fails"), F.count_distinct(F.when(bad, F.col("model"))).alias("failing_models"))


def empirical_difficulty(attempts: DataFrame, approved: tuple[str, ...], bar: float = 1.0) -> DataFrame:
    """The model group that stands for a task: approved first, then most attempts, then earliest; its rate and band."""
    per = attempts.groupBy("task", "model").agg(F.count("*").alias("n"), F.avg(is_pass(F.col("score"), bar).cast("double")).alias("rate"), F.min("attempt").alias("seen"))
    w = Window.partitionBy("task").orderBy(F.col("model").isin(*approved).desc(), F.desc("n"), "seen")
    band = F.when(F.col("rate") <= 0.125, "very_hard").when(F.col("rate") <= 0.25, "hard").when(F.col("rate") <= 0.5, "medium").otherwise("easy")
    return per.withColumn("k", F.row_number().over(w)).where("k = 1").select("task", "model", "n", "rate", band.alias("band"))


def rates_wide(attempts: DataFrame, models: tuple[str, ...], bar: float = 1.0) -> DataFrame:
    """Pass rate of each task by fixed models, and the mean of the rates there are."""
    cols = [F.avg(F.when(F.col("model") == m, is_pass(F.col("score"), bar).cast("double"))).alias(m) for m in models]
    wide = attempts.groupBy("task").agg(*cols)
    have = F.array_compact(F.array(*models))
    return wide.withColumn("mean_rate", F.aggregate(have, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(have), F.lit(0)))


def deficits(attempts: DataFrame, target: int, genuine: Column) -> DataFrame:
    """Genuine attempts of each task and how many are missing to the target."""
    return attempts.groupBy("task").agg(F.count_if(genuine).alias("genuine")).withColumn("deficit", F.greatest(F.lit(target) - F.col("genuine"), F.lit(0)))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; the order must end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


# Marks of runs that the infrastructure spoilt, for the two readings of an attempt.
INFRA_MARKS = ("ratelimit", "rate_limit", "rate limit", "badgateway", "bad gateway", "timeout", "apierror", "serviceunavailable", "502", "503", "504", "no fallback model group", "overloaded", "connection")
RETRY_MARKS = ("ratelimit", "rate_limit", "rate limit", "badgateway", "bad gateway", "no fallback model group", "overloaded", "serviceunavailable", "502", "503", "504", "connection", "apitimeout", "read timed out", "already shut down", "sandbox with container", "sandbox has already")


def _marked(error: Column, marks: tuple[str, ...]) -> Column:
    text = F.lower(F.coalesce(error, F.lit("")))
    out = F.lit(False)
    for m in marks:
        out = out | text.contains(m)
    return out


def _timed_out(error: Column, tokens: Column) -> Column:
    return F.lower(F.coalesce(error, F.lit(""))).contains("agenttimeouterror") & (F.coalesce(tokens, F.lit(0)) > 0)


def classify_attempt(error: Column, tokens: Column, score: Column) -> Column:
    """(genuine, score, reason): a timeout with work done is an unsolved run; spoilt, unscored and empty runs are retried."""

    def answer(genuine: bool, value: Column, reason: str | None) -> Column:
        return F.struct(F.lit(genuine).alias("genuine"), value.cast("double").alias("score"), F.lit(reason).cast("string").alias("reason"))

    none = F.lit(None)
    empty = (F.coalesce(tokens, F.lit(0)) == 0) & (F.coalesce(error, F.lit("")) != "")
    return F.when(_timed_out(error, tokens), answer(True, F.lit(0.0), None)).when(_marked(error, INFRA_MARKS), answer(False, none, "infra")).when(score.isNull(), answer(False, none, "no_score")).when(empty, answer(False, none, "zero_tok_err")).otherwise(answer(True, score, None))


def triage_attempt(error: Column, tokens: Column, score: Column) -> Column:
    """(verdict, score): the second reading, which sets unscored runs aside as broken."""

    def answer(verdict: str, value: Column) -> Column:
        return F.struct(F.lit(verdict).alias("verdict"), value.cast("double").alias("score"))

    return F.when(_timed_out(error, tokens), answer("genuine", F.lit(0.0))).when(_marked(error, RETRY_MARKS), answer("retry", F.lit(None))).when(score.isNull(), answer("broken", F.lit(None))).otherwise(answer("genuine", score))


def is_genuine(error: Column, tokens: Column, score: Column, least: int = 2000) -> Column:
    """A scored run of ``least`` tokens or more without a failed login or a rate limit."""
    bad = F.lit(False)
    for m in ("Authentication", "RateLimit", "Unauthorized"):
        bad = bad | F.coalesce(error, F.lit("")).contains(m)
    return score.isNotNull() & (F.coalesce(tokens, F.lit(0)) >= least) & ~bad


def need(attempts: DataFrame, inflight: DataFrame, k: int, genuine: Column) -> DataFrame:
    """(task, genuine, running, need): what is missing to ``k`` after those done and those under way, tasks of either side."""
    done = attempts.groupBy("task").agg(F.count_if(genuine).alias("genuine"))
    running = inflight.groupBy("task").agg(F.count("*").alias("running"))
    both = done.join(running, "task", "full_outer").na.fill(0, ["genuine", "running"])
    return both.withColumn("need", F.greatest(F.lit(k) - F.col("genuine") - F.col("running"), F.lit(0)))


def failing_everywhere(attempts: DataFrame, bar: float = 1.0) -> DataFrame:
    """(task, check) that no attempt of the task passes; a check that an attempt lacks counts as failing there."""
    return attempts.groupBy("task", "check").agg(F.count_if(is_pass(F.col("score"), bar)).alias("passes")).where("passes = 0").select("task", "check")


def coverage_by_model(attempts: DataFrame, bar: float = 1.0) -> DataFrame:
    """Tasks, runs and passes of each model, from the partial counts of (task, model)."""
    part = attempts.groupBy("model", "task").agg(F.count("*").alias("runs"), F.count_if(is_pass(F.col("score"), bar)).alias("passes"))
    return part.groupBy("model").agg(F.count("*").alias("tasks"), F.sum("runs").alias("runs"), F.sum("passes").alias("passes"))


def completed(attempts: DataFrame) -> DataFrame:
    """Attempts whose status is just ``completed``; a null status is none."""
    return attempts.where(F.col("status") == "completed")


def task_key(name: str = "task_name", id_: str = "task_id") -> Column:
    """The task's name, its id where the name is null or empty."""
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(id_).cast("string"))


def only(rows: DataFrame, spec: str, key: str = "task") -> DataFrame:
    """Rows whose key a list names: names between commas, or with @ the lines of a text file, without blank ones and
    comments. An empty list keeps all rows; a null key is in no list. The list is read by Spark and small or shuffled as its size asks."""
    if not spec:
        return rows
    spark = rows.sparkSession
    if spec.startswith("@"):
        names = spark.read.text(spec[1:]).select(F.trim("value").alias("_name")).where("_name <> '' and _name not like '#%'").distinct()
    else:
        names = spark.range(1).select(F.explode(F.filter(F.split(F.lit(spec), ","), lambda x: x != "")).alias("_name")).distinct()
    return rows.join(names, F.col(key).cast("string") == F.col("_name"), "left_semi") if not names.isEmpty() else rows


def failed_tests(log: Column) -> Column:
    """Distinct names, sorted, of the tests that a verbose log calls FAILED; a null log has none."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(log, F.lit("")), F.lit(r"\b(test_\w+) FAILED"), F.lit(1))))


def distinct_ids(parts: list[DataFrame], key: str) -> DataFrame:
    """The ids of all parts, each once; null counts as one."""
    out = parts[0].select(key)
    for p in parts[1:]:
        out = out.unionByName(p.select(key))
    return out.distinct()


def promoted(meta: Column, aliases: dict[str, str]) -> Column:
    """A map whose missing canonical keys get the value of their alias; the aliases stay. A null map is null."""
    missing = [F.when(~F.map_contains_key(meta, k) & F.map_contains_key(meta, a), F.struct(F.lit(k).alias("k"), meta[a].alias("v"))) for k, a in aliases.items()]
    return F.map_from_entries(F.concat(F.transform(F.map_entries(meta), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))), F.array_compact(F.array(*missing))))


def nearest_eighth(share: Column) -> Column:
    """A share of 0 to 1 at the nearest eighth, halves to the even one; other numbers as they are."""
    return F.when((share >= 0) & (share <= 1), F.rint(share * 8) / 8).otherwise(share)
