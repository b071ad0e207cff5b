"""Reconciliation, completeness and triage of findings by their titles.

A finding is (task, area, severity, title, location, detail, dimension, ref). Runtime signals are (task, builds, oracle,
noop, cheat, mutation): a task without a row was never run, which differs from a row of nulls and from zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.findings import AREAS

# Titles by priority, by remediation, and those that settle a bucket.
P0 = (
    "agent-writable-verifier", "truth-baked-verifier-reads", "tests-bake-verifier-reads", "reference-solve-reads-truth", "unconditional-reward",
    "dockerfile-copies-solution", "dockerfile-copies-tests", "test-imports-solution", "reward-pre-created", "secret-baked-in-image",
    "semantic-cheat-vector", "cheat-confirmed", "pycache-baked-in-image",
)
P1 = (
    "source-match-verification", "verifier-undefended", "wall-clock-dependent-verifier", "filename-encodes-answer", "verifier-self-consistent",
    "literal-only-verifier", "degenerate-integrity-guard", "brittle-string-match", "existence-only-check", "no-assertion-test", "vacuous-test",
    "swallowed-assertion", "weak-assertion", "skipped-scored-test", "empty-parametrize", "golden-patch-mismatch", "flaky-test",
    "test-sh-set-e-reward-abort", "test-sh-swallows-failure", "agent-writable-reward-signal", "verifier-reads-config-spec", "truth-named-baked",
    "test-runtime-install", "reward-path-nonstandard", "tests-bake-unread", "untested-requirement", "pycache-residue-after-script-removal",
)
P2 = (
    "chmod-not-a-guard", "verifier-helper-in-environment", "dockerfile-copies-env-tests", "dockerfile-copies-hint-file", "missing-dockerignore",
    "broad-chmod", "verifier-reads-instruction-input",
)
RELOCATE = (
    "agent-writable-verifier", "truth-baked-verifier-reads", "tests-bake-verifier-reads", "verifier-helper-in-environment", "chmod-not-a-guard",
    "reward-pre-created", "dockerfile-copies-tests", "dockerfile-copies-solution", "reference-solve-reads-truth", "secret-baked-in-image",
    "dockerfile-copies-env-tests", "pycache-baked-in-image", "pycache-residue-after-script-removal",
)
STRENGTHEN = (
    "literal-only-verifier", "source-match-verification", "verifier-undefended", "filename-encodes-answer", "wall-clock-dependent-verifier",
    "verifier-self-consistent", "existence-only-check", "no-assertion-test", "vacuous-test", "swallowed-assertion", "weak-assertion",
    "unconditional-reward", "test-sh-swallows-failure", "test-sh-set-e-reward-abort", "empty-parametrize", "skipped-scored-test",
    "agent-writable-reward-signal", "tests-bake-unread", "truth-named-baked", "conftest-plant-vulnerable",
)
ALIGN = (
    "brittle-string-match", "untested-requirement",
)
CONCRETE = (
    "literal-only-verifier", "source-match-verification", "wall-clock-dependent-verifier", "filename-encodes-answer", "verifier-self-consistent",
    "golden-patch-mismatch", "brittle-string-match", "vacuous-test", "no-assertion-test", "existence-only-check", "swallowed-assertion",
    "empty-parametrize", "skipped-scored-test", "unconditional-reward", "test-sh-swallows-failure", "test-sh-set-e-reward-abort",
    "conftest-plant-vulnerable",
)
BROKEN = (
    "golden-patch-mismatch", "oracle-fails", "reference-fails-own-tests",
)
SOFT = "verifier-undefended"
META = ("verify-refuted", "verify-confirm", "cheat-vector-confirmed", "cheat-vector-refuted")
HARD_DEFENCES = ("recompute-or-hash", "mutated-rerun", "source-grep-guard")
# The dimensions to assess and the area of each; the last three need a runtime signal.
DIMENSIONS = {"alignment": "tests", "coverage": "tests", "hygiene": "tests", "golden-patch": "solution", "realism": "instructions", "constraints": "tests", "category": "metadata", "determinism": "tests", "contract": "instructions", "cheat-vector": "tests"}
SIGNALS = {"oracle-passes": ("oracle", "behavioral"), "noop-fails": ("noop", "behavioral"), "verifier-sound": ("mutation", "tests")}


def resolve(findings: DataFrame) -> DataFrame:
    """Findings after review: refuted ones and review marks go, candidates get their final severity.

    A candidate cheat goes where it was refuted or the verifier is defended, fails where it was confirmed and warns
    otherwise. A writable verifier with a defence that cannot be forged warns instead of failing.
    """
    title, detail = F.col("title"), F.coalesce("detail", F.lit(""))
    hard = F.lit(False)
    for d in HARD_DEFENCES:
        hard = hard | detail.contains(d)
    marks = {"confirmed": title == "cheat-vector-confirmed", "refuted": title == "cheat-vector-refuted", "defended": title == "verifier-defended", "hard": (title == "verifier-defended") & hard}
    flags = findings.groupBy("task").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(f"_{k}") for k, c in marks.items()])
    refuted = findings.where((title == "verify-refuted") & (F.coalesce("ref", F.lit("")) != "")).select("task", F.col("ref").alias("title")).distinct()
    kept = findings.where(~F.coalesce(title, F.lit("")).isin(*META)).join(refuted, ["task", "title"], "left_anti").join(flags, "task")
    cheat = F.coalesce(title, F.lit("")) == "semantic-cheat-vector"
    kept = kept.where(~(cheat & (F.col("_refuted") | F.col("_defended"))))
    forged = (title == "agent-writable-verifier") & (F.col("severity") == "FAIL") & F.col("_hard")
    severity = F.when(cheat, F.when(F.col("_confirmed"), "FAIL").otherwise("WARN")).when(forged, "WARN").otherwise(F.col("severity"))
    return kept.withColumn("severity", severity).select(*findings.columns)


def gaps(findings: DataFrame, signals: DataFrame) -> DataFrame:
    """(task, dimension, area, layer, reason) of each dimension that no finding with evidence, or no signal, covers."""
    evidence = (F.length(F.trim(F.coalesce("detail", F.lit("")))) > 0) | (F.length(F.trim(F.coalesce("location", F.lit("")))) > 0)
    seen = findings.groupBy("task").agg(F.collect_set(F.when(evidence, F.col("dimension"))).alias("covered"), F.collect_set("dimension").alias("named"))
    both = seen.join(signals.select("task", *[c for c, _ in SIGNALS.values()]), "task", "full_outer")
    none = F.array().cast("array<string>")
    covered, named = F.coalesce("covered", none), F.coalesce("named", none)

    def gap(dim: str, area: str, layer: str, reason: Column) -> Column:
        return F.struct(F.lit(dim).alias("dimension"), F.lit(area).alias("area"), F.lit(layer).alias("layer"), reason.alias("reason"))

    read = [F.when(~F.array_contains(covered, d), gap(d, a, "semantic", F.when(F.array_contains(named, d), "asserted-without-evidence").otherwise("not-assessed"))) for d, a in DIMENSIONS.items()]
    run = [F.when(F.col(c).isNull(), gap(d, a, "behavioral", F.lit("not-assessed"))) for d, (c, a) in SIGNALS.items()]
    return both.select("task", F.explode(F.array_compact(F.array(*read, *run))).alias("g")).select("task", "g.*")


def with_gaps(findings: DataFrame, signals: DataFrame) -> DataFrame:
    """Findings and one FAIL, ``qc-incomplete``, for each gap."""
    missing = gaps(findings, signals).select("task", "area", F.lit("FAIL").alias("severity"), F.lit("qc-incomplete").alias("title"), F.lit("").alias("location"), F.col("reason").alias("detail"), "dimension", F.lit(None).cast("string").alias("ref"))
    return findings.unionByName(missing.select(*findings.columns))


def priority(title: Column, severity: Column, area: Column) -> Column:
    """P0 to P2 by title, else by severity and area; '' without a defect."""
    fallback = F.when(severity == "FAIL", F.when(area.isin("anti_cheat", "tests", "dataset"), "P0").otherwise("P1")).when(severity == "WARN", "P2").otherwise("")
    return F.when(title.isin(*P0), "P0").when(title.isin(*P1), "P1").when(title.isin(*P2), "P2").otherwise(fallback)


def buckets(findings: DataFrame, signals: DataFrame) -> DataFrame:
    """(task, bucket, status, remediation, priority, confidence, needs_behavioral, tags) of each task with findings.

    The area that names a plain failure is the first in the fixed order of areas.
    """
    f = findings.where(F.col("severity").isin("FAIL", "WARN"))
    title, real, fail = F.col("title"), F.coalesce(F.col("title"), F.lit("")) != SOFT, F.col("severity") == "FAIL"

    def any_of(titles: list[str]) -> Column:
        return F.coalesce(F.bool_or(title.isin(*titles)), F.lit(False))

    place = F.array_position(F.array(*map(F.lit, AREAS)), F.col("area"))
    flags = f.groupBy("task").agg(
        F.min(F.when(real, priority(title, F.col("severity"), F.col("area")))).alias("p"),
        F.coalesce(F.bool_or(real & fail), F.lit(False)).alias("failed"),
        F.min(F.when(real & fail, F.struct(F.when(place > 0, place).otherwise(99).alias("k"), F.col("area").alias("area"))))["area"].alias("first"),
        any_of(BROKEN).alias("broken"),
        any_of(CONCRETE).alias("concrete"),
        any_of(RELOCATE).alias("relocate"),
        any_of(STRENGTHEN).alias("strengthen"),
        any_of(ALIGN).alias("align"),
    )
    s = signals.select("task", F.lit(True).alias("ran"), "builds", "oracle", "noop", "cheat", "mutation")
    t = findings.select("task").distinct().join(flags, "task", "left").join(s, "task", "left")

    def yes(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(False))

    p = F.coalesce("p", F.lit(""))
    total = F.when(F.col("builds") == F.lit(False), "unviable").when((F.col("oracle") == 0) | yes("broken"), "broken-oracle").when((F.col("noop") == 1) | (F.col("cheat") == 1), "gameable")
    fixable = yes("failed") | (p == "P0") | yes("concrete")
    by_area = F.when(F.col("first") == "metadata", "metadata").when(F.col("first") == "structure", "add-file").when(F.col("first") == "dockerfile", "dockerfile").otherwise("review")
    fix = F.when(yes("relocate"), "relocate").when(yes("concrete") | yes("strengthen"), "strengthen").when(yes("align"), "align").otherwise(by_area)
    bucket = F.when(total.isNotNull(), "total").when(fixable, "fixable").when(p == "P1", "review").otherwise("ship")
    known = F.coalesce("builds", F.col("oracle").cast("boolean"), F.col("noop").cast("boolean"), F.col("cheat").cast("boolean"), F.col("mutation").cast("boolean")).isNotNull()
    out = t.select("task", p.alias("priority"), bucket.alias("bucket"), F.coalesce(total, F.when(fixable, fix), F.lit("")).alias("remediation"), (yes("ran") & known).alias("confirmed"), (~yes("ran")).alias("unrun"))
    status = F.when(F.col("bucket") == "ship", "passing").when(F.col("bucket") == "fixable", "needs-fixing").when(F.col("bucket") == "total", "defective-hard").otherwise("needs-review")
    needs = F.col("unrun") & F.col("bucket").isin("fixable", "review")
    remedy = F.when(F.col("remediation") == "", None).when(F.col("bucket") == "total", F.concat(F.lit("qc:"), "remediation")).otherwise(F.concat(F.lit("qc:fix-"), "remediation"))
    tags = F.array_compact(F.array(F.concat(F.lit("qc:"), "bucket"), F.concat(F.lit("qc:"), status), remedy, F.when(F.col("priority") != "", F.concat(F.lit("qc:"), F.lower("priority"))), F.when(F.col("confirmed"), "qc:confirmed").otherwise("qc:candidate"), F.when(needs, "qc:needs-behavioral")))
    return out.select("task", "bucket", status.alias("status"), "remediation", "priority", F.when(F.col("confirmed"), "confirmed").otherwise("candidate").alias("confidence"), needs.alias("needs_behavioral"), tags.alias("tags"))


def defects(findings: DataFrame) -> DataFrame:
    """Failures and warnings with their priority and text on one line, by priority, failures first, task and area."""
    flat = F.trim(F.regexp_replace(F.coalesce("detail", F.lit("")), r"\s+", " "))
    p = priority(F.col("title"), F.col("severity"), F.col("area"))
    rows = findings.where(F.col("severity").isin("FAIL", "WARN")).select("task", p.alias("priority"), "severity", "area", "title", flat.alias("detail"))
    return rows.orderBy(F.when(F.col("priority") == "", "P9").otherwise(F.col("priority")), F.col("severity") != "FAIL", "task", "area", "title")


def calibrated(findings: DataFrame, blocking: DataFrame, gate: str = "area") -> DataFrame:
    """(task, gate, verdict): FAIL with a failure whose title is in the small table ``blocking``, WARN with other flags."""
    marked = findings.join(blocking.select("title", F.lit(True).alias("blocks")).distinct(), "title", "left")
    rank = F.when((F.col("severity") == "FAIL") & F.coalesce("blocks", F.lit(False)), 2).when(F.col("severity").isin("FAIL", "WARN"), 1).otherwise(0)
    worst = F.max(rank)
    return marked.groupBy("task", F.col(gate).alias("gate")).agg(F.when(worst == 2, "FAIL").when(worst == 1, "WARN").otherwise("PASS").alias("verdict"))


def roll_up(sections: DataFrame) -> DataFrame:
    """(task, verdict, failed): of (task, modules array<struct<name, dims array<struct<dim, status>>>>), fail over neutral over clean."""
    dims = sections.select("task", F.explode_outer("modules").alias("m")).select("task", "m.name", F.explode_outer("m.dims").alias("d"))
    rank = F.max(F.when(F.col("d.status") == "fail", 2).when(F.col("d.status") == "neutral", 1).otherwise(0))
    failed = F.array_sort(F.collect_set(F.when(F.col("d.status") == "fail", F.concat_ws(" / ", "name", "d.dim"))))
    return dims.groupBy("task").agg(F.when(rank == 2, "fail").when(rank == 1, "neutral").otherwise("clean").alias("verdict"), failed.alias("failed"))


def container_verdict(policy: str, noop_reward: Column, noop_code: Column, oracle_reward: Column, oracle_code: Column) -> Column:
    """OK, ORACLE-FAIL or NOOP-PASS of one container run: a failing reference counts before a passing no-op.

    Policies: ``exit`` looks at exit codes, ``reward`` at reward files (a missing one fails), ``either`` at the reward
    file and without one at the code, ``oracle`` at the reference's code alone.
    """

    def one(reward: Column) -> Column:
        return F.coalesce(F.abs(reward.try_cast("double") - 1.0) < 1e-9, F.lit(False))

    def zero(code: Column) -> Column:
        return F.coalesce(code == 0, F.lit(False))

    def either(reward: Column, code: Column) -> Column:
        return F.when(F.coalesce(reward, F.lit("")) != "", one(reward)).otherwise(zero(code))

    good, free = {"exit": (zero(oracle_code), zero(noop_code)), "reward": (one(oracle_reward), one(noop_reward)), "either": (either(oracle_reward, oracle_code), either(noop_reward, noop_code)), "oracle": (zero(oracle_code), F.lit(False))}[policy]
    return F.when(~good, "ORACLE-FAIL").when(free, "NOOP-PASS").otherwise("OK")


def behavioral_verdict(golden: Column, empty: Column) -> Column:
    return F.when(golden.isNull(), "unknown").when(golden < 1, "broken-oracle").when(F.coalesce(empty, F.lit(0.0)) > 0, "noop-passes").otherwise("oracle-healthy")


def behavioral_label(verdict: Column) -> Column:
    """What a verdict sets: (oracle, status, remediation, confidence); null for unknown."""
    bad = verdict.isin("broken-oracle", "noop-passes")
    remedy = F.when(verdict == "broken-oracle", "broken-oracle").when(verdict == "noop-passes", "gameable")
    return F.when(verdict != "unknown", F.struct(F.when(bad, "fail").otherwise("pass").alias("oracle"), F.when(bad, "defective-hard").alias("status"), remedy.alias("remediation"), F.when(bad, "confirmed").alias("confidence")))


def cull(oracle: Column, leak: Column) -> Column:
    """CULL or READY and the reasons, of the two statuses."""
    reasons = F.array_compact(F.array(F.when(oracle.isin("ORACLE-FAIL", "NOOP-PASS", "BUILD-FAIL", "EXC", "EXEC-ERROR"), F.concat(F.lit("oracle:"), oracle)), F.when(leak.isin("LEAK-CONFIRMED", "NOOP-PASS"), F.concat(F.lit("leak:"), leak))))
    return F.struct(F.when(F.size(reasons) > 0, "CULL").otherwise("READY").alias("verdict"), reasons.alias("reasons"))
