"""Findings over the files of task packages: Python tests, Dockerfiles and shell scripts, by their own grammars.

``files`` has task, rel_path and text, one row a file. Findings have task, area, severity, title, location and detail. A
package without findings has no row here; sentinels are given where gates are put together. Files whose text is null or
blank, or that a package lacks, give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.docker_facts import DockerFacts
from assay.functions.python_facts import PythonFacts
from assay.functions.shell_facts import ShellLines

FINDING = ("task", "area", "severity", "title", "location", "detail")
DOCKERFILE, TEST_PY, TEST_SH, SOLVE = "environment/Dockerfile", "tests/test_outputs.py", "tests/test.sh", "solution/solve.sh"

# The kinds of Python facts that are findings, with area and title.
PYTHON_TITLES = (
    ("vacuous", "anti_cheat", "vacuous-test"),
    ("swallowed", "anti_cheat", "swallowed-assertion"),
    ("existence-only", "anti_cheat", "existence-only-check"),
    ("no-assertion", "anti_cheat", "no-assertion-test"),
    ("skipped", "anti_cheat", "skipped-scored-test"),
    ("empty-parametrize", "anti_cheat", "empty-parametrize"),
    ("imports-solution", "anti_cheat", "test-imports-solution"),
    ("literal-only", "tests", "literal-only-verifier"),
    ("syntax-error", "structure", "python-syntax-error"),
)
APPROVED_IMAGES = ("golang", "python", "debian", "rust", "node", "ubuntu", "eclipse-temurin", "ruby", "maven", "gcc")
APPROVED_REGISTRY = "public.ecr.aws/docker/library/"
BUILDS = r"(?i)\b(cargo build|mvn(\s+\S+)*?\s+package|go build|dotnet publish|gradle(\s+\S+)*?\s+build|npm\s+run\s+build|npm\s+ci\b|yarn\s+build)\b"
APT_INSTALL, APT_UPDATE = r"(?i)\b(?:apt-get|apt)\s+(?:-y\s+)?install\b", r"(?i)\b(?:apt-get|apt)\s+update\b"
STANDARD_REWARD = "/logs/verifier/reward.txt"
REWARDISH = r"(?i)(reward|score|status|verdict|result|pass)\b"


def finding(area: str, severity: str, title: str, location: Column, detail: Column) -> list[Column]:
    return [F.col("task"), F.lit(area).alias("area"), F.lit(severity).alias("severity"), F.lit(title).alias("title"), location.alias("location"), detail.alias("detail")]


def python_facts(files: DataFrame, literals: bool = True) -> DataFrame:
    """(task, rel_path, function, line, kind, path, value) of every fact of the files below tests/ that end in .py; without
    ``literals`` of those that are findings alone."""
    tests = files.where(F.col("rel_path").rlike(r"^tests/(.*/)?[^/]+\.py$"))
    return tests.lateralJoin(PythonFacts(F.col("text").outer(), F.lit(literals))).select("task", "rel_path", "function", "line", "kind", "path", "value")


def test_findings(files: DataFrame) -> DataFrame:
    """Findings of test files; what holds for a verifier as a whole is asked of its main file alone."""
    titles = F.create_map(*[F.lit(x) for kind, area, title in PYTHON_TITLES for x in (kind, f"{area} {title}")])
    facts = python_facts(files, literals=False).withColumn("t", F.split(titles[F.col("kind")], " ")).where("t is not null")
    facts = facts.where(~F.col("kind").isin("literal-only", "syntax-error") | (F.col("rel_path") == TEST_PY))
    return facts.select("task", F.col("t")[0].alias("area"), F.lit("FAIL").alias("severity"), F.col("t")[1].alias("title"), F.concat_ws(":", "rel_path", "line").alias("location"), F.coalesce("function", "value", F.lit("")).alias("detail"))


def docker_instructions(files: DataFrame) -> DataFrame:
    """(task, stage, line, instr, args, body) of the packages' Dockerfiles."""
    return files.where(F.col("rel_path") == DOCKERFILE).lateralJoin(DockerFacts(F.col("text").outer())).select("task", "stage", "line", "instr", "args", "body")


def shell_of(instr: Column, args: Column, body: Column) -> Column:
    """The commands of a RUN instruction: its arguments, and its heredoc where that is the script itself."""
    return F.when(instr == "RUN", F.when(args.startswith("<<"), F.concat_ws("\n", args, body)).otherwise(args))


def unpinned_packages(command: Column) -> Column:
    """Packages that pip installs without any version: no option, path, address or file of requirements."""
    calls = F.regexp_extract_all(command, F.lit(r"(?i)\bpip3?\s+install\b([^\n&|;]*)"), F.lit(1))
    words = F.flatten(F.transform(calls, lambda c: F.split(F.trim(c), r"\s+")))
    # what follows an option that takes a value is no package
    valued = F.transform(words, lambda w, i: F.when((i > 0) & F.get(words, i - 1).isin("-r", "--requirement", "-c", "--constraint", "-i", "--index-url", "--extra-index-url", "-t", "--target"), F.lit("-")).otherwise(w))
    return F.filter(valued, lambda w: w.rlike(r"^[A-Za-z0-9_][A-Za-z0-9_.\[\]-]*$"))


def docker_findings(files: DataFrame, delivery: DataFrame | None = None, instructions: DataFrame | None = None) -> DataFrame:
    """Findings that hang on instructions. ``delivery`` (task) names the packages held to the rules for deliveries."""
    steps = (docker_instructions(files) if instructions is None else instructions).withColumn("run", shell_of(F.col("instr"), F.col("args"), F.col("body")))
    ref = F.when(F.col("instr") == "FROM", F.regexp_extract("args", r"^(?:--\S+\s+)*(\S+)", 1))
    steps = steps.withColumn("ref", ref).withColumn("pip", unpinned_packages(F.col("run")))
    ours = F.col("ref").isNotNull() & ~F.col("ref").startswith("$") & (F.lower("ref") != "scratch")
    tag = F.regexp_extract("ref", r"^[^@]*?([^/@:]+)(?::([^/@:]+))?(?:@.*)?$", 2)
    image = F.lower(F.regexp_extract("ref", r"^(?:[^@]*/)?([^/@:]+)", 1))
    loose = ours & ~F.col("ref").contains("@sha256") & F.lower(tag).isin("", "latest")
    per = steps.groupBy("task").agg(
        F.collect_set(F.when(loose, F.col("ref"))).alias("loose"),
        F.collect_set(F.when(ours & ~F.col("ref").contains("@sha256") & ~loose, F.col("ref"))).alias("undigested"),
        F.collect_set(F.when(ours & ~(F.col("ref").contains(APPROVED_REGISTRY) & image.isin(*APPROVED_IMAGES)), F.col("ref"))).alias("foreign"),
        F.count_if(F.col("run").rlike(APT_INSTALL)).alias("apt"),
        F.count_if(F.col("run").rlike(APT_UPDATE)).alias("updates"),
        F.count_if(F.col("run").rlike(BUILDS)).alias("builds"),
        F.count("ref").alias("stages"),
        F.flatten(F.collect_set("pip")).alias("pip"),
        F.min(F.when(F.col("body").isNotNull(), F.col("line"))).alias("heredoc"),
        F.min(F.when((F.col("instr") == "ADD") & F.col("args").rlike(r"^(--\S+\s+)*https?://"), F.col("line"))).alias("remote"),
        F.min(F.when(F.col("instr") == "ENTRYPOINT", F.col("line"))).alias("entry"),
    )
    held = F.lit(False)
    if delivery is not None:
        per, held = per.join(delivery.select("task", F.lit(True).alias("held")), "task", "left"), F.coalesce("held", F.lit(False))
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.col(c))), ", ")
    none = F.lit("")
    rules = (
        (F.size("loose") > 0, "FAIL", "unpinned-base-image", names("loose")),
        (held & (F.size("undigested") > 0), "FAIL", "base-image-not-digest-pinned", names("undigested")),
        (held & (F.size("foreign") > 0), "FAIL", "base-image-not-approved", names("foreign")),
        ((F.col("apt") > 0) & (F.col("updates") == 0), "FAIL", "apt-no-update", none),
        (F.col("apt") > 1, "WARN", "apt-not-consolidated", F.col("apt").cast("string")),
        (F.size("pip") > 0, "WARN", "unpinned-pip", names("pip")),
        ((F.col("builds") > 0) & (F.col("stages") < 2), "WARN", "missing-multistage-build", none),
        (F.col("heredoc").isNotNull(), "FAIL", "dockerfile-heredoc-source", F.col("heredoc").cast("string")),
        (F.col("remote").isNotNull(), "FAIL", "add-remote-url", F.col("remote").cast("string")),
        (F.col("entry").isNotNull(), "FAIL", "dockerfile-entrypoint", F.col("entry").cast("string")),
    )
    hits = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(s).alias("severity"), F.lit(t).alias("title"), d.alias("detail"))) for when, s, t, d in rules]))
    return per.select("task", F.explode(hits).alias("f")).select("task", F.lit("dockerfile").alias("area"), "f.severity", "f.title", F.lit(DOCKERFILE).alias("location"), "f.detail")


def shell_lines(files: DataFrame) -> DataFrame:
    """(task, rel_path, line, command, depth, stops, marker) of every command and heredoc line of the .sh files."""
    return files.where(F.col("rel_path").endswith(".sh")).lateralJoin(ShellLines(F.col("text").outer())).select("task", "rel_path", "line", "command", "depth", "stops", "marker")


def verifier_findings(files: DataFrame, delivery: DataFrame | None = None) -> DataFrame:
    """Findings of tests/test.sh. A reward counts as guarded inside an if or case, or by a test of a status in its own
    line or the six lines before; commands alone count, not the lines of heredocs."""
    lines = shell_lines(files.where(F.col("rel_path") == TEST_SH)).where("marker is null")
    command = F.col("command")
    guard = command.rlike(r"(\$\?|-eq\s*0|-ne\s*0|test_status|exit_code|returncode|\bif\s|\$test|&&)")
    before = Window.partitionBy("task").orderBy("line").rangeBetween(-6, 0)
    lines = lines.withColumn("guarded", F.max(guard).over(before) | (F.col("depth") > 0))
    passes = command.rlike(r"(echo|printf)\s+['\"]?1['\"]?\s*>") & command.rlike(REWARDISH)
    runs = command.rlike(r"(-m\s+pytest|\bpytest(\s+[-/.\w]|\s*$))")
    kept = command.rlike(r"\|\|\s*(true|:)(\s|;|$)")
    fetches = command.rlike(r"(?i)\b(apt-get\s+(-y\s+)?install|apt\s+install|pip3?\s+install|python3?\s+-m\s+pip\s+install|conda\s+install|npm\s+(install|ci)|gem\s+install|cargo\s+install|go\s+install)\b") | command.rlike(r"(?i)\b(curl|wget)\b[^|]*\|\s*(sudo\s+)?(ba)?sh\b")
    reward = F.regexp_extract(command, r"(?i)>>?\s*[\"']?(/[^\s\"';)&|]*reward[^\s\"';)&|]*)", 1)
    lines = lines.withColumn("reward", F.when((reward != "") & ~reward.rlike(r"[${]"), reward))
    other = runs & ~command.rlike(r"(?i)(apt-get|apt\s|dpkg|pip3?\s*install|-m\s+pip|conda\s+install|\binstall\b|\b(cp|mv|cat|cmp|diff|chmod|mkdir|ln)\b)")

    def first(when: Column) -> Column:
        return F.min(F.when(when, F.col("line")))

    per = lines.groupBy("task").agg(
        first(other & kept).alias("swallows"),
        first(passes & ~F.col("guarded")).alias("free"),
        first(runs & F.col("stops") & ~kept & ~command.rlike(r"^(if|while|until)\b|&&|\|\|")).alias("stopped"),
        F.max(command.rlike(r"\$\?|^if\s.*pytest")).alias("branches"),
        F.max(command.rlike(r"(?i)(reward|score).*>|>\s*\S*reward")).alias("rewards"),
        first(fetches).alias("fetches"),
        F.min(F.when(F.col("reward").isNotNull(), F.struct("line", "reward"))).alias("odd"),
        F.max(F.coalesce(F.col("reward") == STANDARD_REWARD, F.lit(False))).alias("standard"),
    )
    held = F.lit(False)
    if delivery is not None:
        per, held = per.join(delivery.select("task", F.lit(True).alias("held")), "task", "left"), F.coalesce("held", F.lit(False))
    rules = (
        (F.col("swallows").isNotNull(), "test-sh-swallows-failure", F.col("swallows")),
        (F.col("free").isNotNull(), "unconditional-reward", F.col("free")),
        (F.col("stopped").isNotNull() & F.col("branches") & F.col("rewards"), "test-sh-set-e-reward-abort", F.col("stopped")),
        (held & F.col("fetches").isNotNull(), "test-runtime-install", F.col("fetches")),
        (held & F.col("odd").isNotNull() & ~F.col("standard"), "reward-path-nonstandard", F.col("odd.line")),
    )
    hits = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(t).alias("title"), n.cast("string").alias("line"))) for when, t, n in rules]))
    return per.select("task", F.explode(hits).alias("f")).select("task", F.lit("anti_cheat").alias("area"), F.lit("FAIL").alias("severity"), "f.title", F.concat_ws(":", F.lit(TEST_SH), "f.line").alias("location"), F.lit("").alias("detail"))
