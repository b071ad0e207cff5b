"""What judging models answered, made whole: findings of each answer, and a FAIL for all that a review left out.

``answers`` has task, role, stop_reason and text, one row an answer; several answers of a task and role count together. The
task of a finding is that of its answer, whatever the model wrote. Null tasks are a task of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.judge_facts import FIELDS, JudgeFindings

REVIEWER = "reviewer"
# What a review must cover, with the area that each gap counts for.
DIMENSIONS = {"alignment": "instructions", "coverage": "tests", "hygiene": "instructions", "golden-patch": "solution", "realism": "instructions", "constraints": "tests", "category": "metadata", "determinism": "tests", "contract": "instructions"}
# The checks that a review must name in a detail, with dimension and area.
CHECKS = {"Q1": ("coverage", "tests"), "Q2": ("golden-patch", "solution"), "Q3": ("alignment", "instructions"), "Q4": ("coverage", "tests")}
COLUMNS = ("task", "role", *FIELDS)


def _said(name: str):
    return F.length(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s", " "))) > 0


def answered(answers: DataFrame) -> DataFrame:
    """The findings of each answer; one with an empty array has none."""
    return answers.lateralJoin(JudgeFindings(F.col("text").outer(), F.col("stop_reason").outer())).select(*COLUMNS)


def review_gaps(found: DataFrame, answers: DataFrame) -> DataFrame:
    """A FAIL for each dimension without evidence and each check without a mention in a reviewed task, in ``COLUMNS``.

    Each answer adds a row of nulls, for an outer lateral join to a Python table function gives none where that is empty.

    Evidence is a detail or location that is not blank. A task's state is three sets of at most 9, 9 and 15 values, so
    partial sets are merged before the shuffle and a hot task is no large group.
    """
    held = F.col("dimension").isin(*DIMENSIONS)
    checks = F.array_sort(F.array_distinct(F.regexp_extract_all(F.upper(F.coalesce("detail", F.lit(""))), F.lit(r"\b(Q[1-4])\s*:"), F.lit(1))))
    every = found.unionByName(answers.select("task", "role"), allowMissingColumns=True)
    per = every.where(F.col("role") == REVIEWER).groupBy("task").agg(
        F.collect_set(F.when(held & (_said("detail") | _said("location")), F.col("dimension"))).alias("covered"),
        F.collect_set(F.when(held, F.col("dimension"))).alias("named"),
        F.flatten(F.collect_set(checks)).alias("checks"),
    )

    def gap(lacks, dimension: str, area: str, title: str, detail):
        values = {"dimension": F.lit(dimension), "area": F.lit(area), "severity": F.lit("FAIL"), "title": F.lit(title), "location": F.lit(""), "detail": detail, "fix": F.lit("review it again, with evidence"), "layer": F.lit("semantic")}
        return F.when(lacks, F.struct(*[values[n].alias(n) for n in FIELDS]))

    reason = lambda d: F.when(F.array_contains("named", d), "asserted-without-evidence").otherwise("not-assessed")
    each = [gap(~F.array_contains("covered", d), d, a, "dimension-not-assessed", reason(d)) for d, a in DIMENSIONS.items()]
    each += [gap(~F.array_contains("checks", q), d, a, "mandatory-check-not-assessed", F.lit(q)) for q, (d, a) in CHECKS.items()]
    return per.select("task", F.lit(REVIEWER).alias("role"), F.explode(F.array_compact(F.array(*each))).alias("g")).select("task", "role", "g.*")


def judged(answers: DataFrame) -> DataFrame:
    """Findings of all answers and the gaps of the reviews."""
    found = answered(answers)
    return found.unionByName(review_gaps(found, answers))
