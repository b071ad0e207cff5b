"""Findings: rules over texts, reconciliation, verdicts, gates, coverage and scoring.

A finding is (task, area, severity, title, location, detail, layer). Verdicts are the worst severity of an area; an
area without findings stays null ("not assessed") through every output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severities by rank, areas in column order, and the layer of each area.
SEVERITIES = ("PASS", "WARN", "FAIL")
AREAS = ("structure", "metadata", "dockerfile", "anti_cheat", "dataset", "instructions", "tests", "solution", "behavioral")
LAYERS = {"behavioral": "behavioral", "anti_cheat": "semantic", "solution": "semantic"}


@dataclass(frozen=True)
class TextRule:
    area: str
    severity: str
    title: str
    pattern: str


TEXT_RULES = (
    TextRule("dataset", "FAIL", "secret-in-text", r"(password|token|secret)\s*=\s*"),
    TextRule("dataset", "WARN", "email-address", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}\.[A-Za-z]{2,}"),
    TextRule("metadata", "WARN", "license-line", r"(Licensed under|All rights reserved|Copyright)"),
    TextRule("instructions", "FAIL", "shouting", r"[A-Z]{2,}!! [A-Z]{2,}!!"),
    TextRule("structure", "WARN", "pipe-separated", r"[^ ]{1,200} \| [^ ]{1,200} \| [^ ]{1,200} \| "),
    TextRule("tests", "FAIL", "symbol-noise", r"(\*\*\*|%%%|&&&|\$\$\$|###)"),
)


def rank(severity: Column) -> Column:
    """0, 1, 2 for PASS, WARN, FAIL; unknown severities rank 0."""
    return F.when(severity == "FAIL", 2).when(severity == "WARN", 1).otherwise(0)


def severity(r: Column) -> Column:
    return F.when(r.isNull(), None).when(r == 2, "FAIL").when(r == 1, "WARN").otherwise("PASS")


def layer_of(area: Column) -> Column:
    out = F.lit("static")
    for a, layer in LAYERS.items():
        out = F.when(area == a, layer).otherwise(out)
    return F.when(area.isin(*AREAS), out).otherwise("unknown")


def text_findings(docs: DataFrame, rules: tuple[TextRule, ...] = TEXT_RULES, task: str = "doc_id", text: str = "text") -> DataFrame:
    """One finding for each rule that a text meets, and a PASS sentinel where none does: one pass over the texts."""
    hits = F.array(*[F.when(F.col(text).rlike(r.pattern), F.struct(F.lit(r.area).alias("area"), F.lit(r.severity).alias("severity"), F.lit(r.title).alias("title"))) for r in rules])
    clean = F.array(F.struct(F.lit("structure").alias("area"), F.lit("PASS").alias("severity"), F.lit("clean").alias("title")))
    # the patterns run once, in a projection of their own
    found = docs.select(F.col(task).alias("task"), F.array_compact(hits).alias("found"))
    rows = found.select("task", F.explode(F.when(F.size("found") > 0, F.col("found")).otherwise(clean)).alias("f"))
    return rows.select("task", "f.area", "f.severity", "f.title", layer_of(F.col("f.area")).alias("layer"))


def reconcile(findings: DataFrame, refuted: DataFrame) -> DataFrame:
    """Findings without those refuted by (task, title)."""
    return findings.join(refuted.select("task", "title").distinct(), ["task", "title"], "left_anti")


def verdicts(findings: DataFrame) -> DataFrame:
    """Worst severity of each area as columns, overall over all findings, and the sorted titles of failures."""
    per_area = [severity(F.max(F.when(F.col("area") == a, rank(F.col("severity"))))).alias(a) for a in AREAS]
    titles = F.array_join(F.array_sort(F.collect_set(F.when(F.col("severity") == "FAIL", F.col("title")))), "; ")
    return findings.groupBy("task").agg(*per_area, severity(F.max(rank(F.col("severity")))).alias("overall"), titles.alias("critical_issues"))


def gate(findings: DataFrame, block: str = "FAIL") -> DataFrame:
    """(task, promoted, layers, titles): a task with a finding at ``block`` or worse is quarantined with its reasons."""
    bad = rank(F.col("severity")) >= SEVERITIES.index(block)
    return findings.groupBy("task").agg((~F.bool_or(bad)).alias("promoted"), F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col("layer")))), ",").alias("layers"), F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col("title")))), ",").alias("titles"))


def coverage_gaps(findings: DataFrame, dimensions: tuple[str, ...] = AREAS) -> DataFrame:
    """(task, area) not assessed: each task's required areas, a constant array, less those it has."""
    return findings.groupBy("task").agg(F.collect_set("area").alias("has")).select("task", F.explode(F.array_except(F.array(*map(F.lit, dimensions)), F.col("has"))).alias("area"))


def distribution(findings: DataFrame) -> DataFrame:
    """Failures by area, by area and title, and in all."""
    fails = findings.where("severity = 'FAIL'")
    return fails.groupingSets([["area"], ["area", "title"], []], "area", "title").agg(F.count("*").alias("n"))


def scorecard(predicted: DataFrame, labels: DataFrame) -> DataFrame:
    """Confusion counts, precision, recall and F1 of (task, flagged) against (task, is_defect); undefined is null."""
    both = predicted.join(labels, "task")
    n = both.agg(F.count_if(F.expr("flagged and is_defect")).alias("tp"), F.count_if(F.expr("flagged and not is_defect")).alias("fp"), F.count_if(F.expr("not flagged and is_defect")).alias("fn"), F.count_if(F.expr("not flagged and not is_defect")).alias("tn"))
    return n.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "recall": F.try_divide("tp", F.col("tp") + F.col("fn")), "f1": F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def supersede(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace the old ones with their key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
