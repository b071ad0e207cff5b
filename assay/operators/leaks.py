"""Leaks through image layers: what a build writes, what later layers remove, and what the verifier and the reference read.

Paths are facts in long tables. A write survives unless a removed path is the write itself or one of its folders; that is
an equi-join of the removed paths with the folders of each write, so no task compares all its paths with all others.
Reads meet writes by path or by file name. ``files`` has task, rel_path and text. Writes through variables and encoded
reads are not followed. Null texts and packages without a build give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.sources import DOCKERFILE, SOLVE, TEST_PY, TEST_SH, docker_instructions
from assay.session import with_checkpoints

# Names of build scripts, of truths and of graders; kinds of files and folders that hold none.
BUILD_SCRIPT = r"^environment/(.*/)?(setup_commands\.sh|setup\.sh|setup_env\.sh|init\.sh|bootstrap[^/]*\.sh|prestart[^/]*\.sh|entrypoint\.sh|docker-entrypoint\.sh|build\.sh|[^/]*setup[^/]*\.sh|generate[^/]*\.py|gen_[^/]*\.py|[^/]*mutate[^/]*\.py|make_[^/]*\.py|seed[^/]*\.py)$"
TRUTHY = r"(?i)(truth|golden|expected|reference|\.ref\b|_hash|hidden|answer|\.verifier|lineage|oracle|ground|secret|private)"
GRADERISH = r"(?i)(verif|validat|grade|grader|judge|checker|scorer|oracle)"
SOURCE_FILE = r"(?i)\.(py|go|c|cc|cpp|h|hpp|js|ts|java|rs|rb|sh|pl|php|scala|kt)$"
CONFIG_FILE = r"(?i)\.(json|yaml|yml|toml|ini|cfg|conf|env|properties)$"
INPUT_FOLDER = r"(?i)/(incoming|in[-_]?folder|in[-_]?box|inputs?|raw|fixtures?|samples?|corpus|evidence|data|datasets?|policy|policies|config|configs|probes?|grids?|streams?|logs?|journals?|uploads?|feed)s?(/|$)"
SCRATCH_FOLDER = r"(?i)/(\.?cache|caches?|tmp|temp|work|scratch|run|state|build|dist|out|output)s?(/|$)"
GRADER_FOLDER = r"(?i)/(verifier|grader|checker|judge|harness)s?(/|$)"
_PATH = r"(/[A-Za-z0-9_.][^\s'\";)&|]*)"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folders(path: Column) -> Column:
    """The path and every folder above it: /a/b/c gives /a, /a/b and /a/b/c."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def build_texts(files: DataFrame, instructions: DataFrame) -> DataFrame:
    """(task, text) of every command text of a build: RUN instructions with their heredocs, and build scripts."""
    steps = instructions.where("instr = 'RUN'").select("task", F.concat_ws("\n", "args", "body").alias("text"))
    return steps.unionByName(files.where(F.col("rel_path").rlike(BUILD_SCRIPT)).select("task", "text"))


def copied(instructions: DataFrame) -> DataFrame:
    """(task, source, path) of what COPY and ADD put into an image; several sources, or a folder, keep their names there."""
    words = F.split(F.regexp_replace("args", r"^(--\S+\s+)+", ""), r"\s+")
    steps = instructions.where("instr in ('COPY', 'ADD') and args not like '[%' and body is null").withColumn("w", words).where(F.size("w") > 1)
    target = F.element_at("w", -1)
    each = steps.select("task", target.alias("target"), (target.endswith("/") | (F.size("w") > 2)).alias("folder"), F.explode(F.slice("w", 1, F.size("w") - 1)).alias("source"))
    whole = F.concat(F.regexp_replace("target", "/+$", ""), F.lit("/"), base_name(F.regexp_replace("source", "/+$", "")))
    return each.select("task", "source", F.when(F.col("folder"), whole).otherwise(F.col("target")).alias("path")).where("path like '/%'")


def build_writes(instructions: DataFrame, builds: DataFrame) -> DataFrame:
    """(task, path), distinct, of absolute paths that a build copies or writes."""
    patterns = (rf"(?<![<0-9&])>>?\s*{_PATH}", rf"\b(?:cp|mv)\s+[^\n;&|]*?\s{_PATH}\s*(?:$|[\n;&|])", r"open\(\s*['\"](/[^'\"]+)['\"]\s*,\s*['\"][wax]", r"makedirs\(\s*['\"](/[^'\"]+)['\"]")
    texts = builds.select("task", F.explode(F.flatten(F.array(*[_all(F.col("text"), p) for p in patterns]))).alias("path"))
    paths = texts.unionByName(copied(instructions).select("task", "path")).select("task", F.regexp_replace("path", "[/.,]+$", "").alias("path"))
    return paths.where(~F.col("path").rlike(r"^/(tmp|proc|sys|dev|run)(/|$)") & (F.col("path") != "")).distinct()


def removed(builds: DataFrame) -> DataFrame:
    """(task, gone), distinct, of absolute paths that a build removes."""
    calls = F.explode(_all(F.col("text"), r"\brm\s+-[a-zA-Z]*[rf][a-zA-Z]*\s+([^\n;&|]+)"))
    words = builds.select("task", calls.alias("c")).select("task", F.explode(F.split(F.trim("c"), r"\s+")).alias("gone"))
    return words.where("gone like '/_%'").select("task", F.regexp_replace("gone", "/+$", "").alias("gone")).distinct()


def survivors(writes: DataFrame, gone: DataFrame) -> DataFrame:
    """``writes`` (task, path) with ``survives``: neither the path nor a folder above it is removed."""
    hit = writes.select("task", "path", F.explode(folders(F.col("path"))).alias("gone")).join(gone, ["task", "gone"], "left_semi").select("task", "path").distinct()
    return writes.join(hit.withColumn("hit", F.lit(True)), ["task", "path"], "left").select("task", "path", F.col("hit").isNull().alias("survives"))


def texts_of(files: DataFrame, **names: tuple[str, ...]) -> DataFrame:
    """One row a package: under each name the texts of these files, in this order, empty without any; files are grouped once."""
    place = {p: k for k, p in enumerate(p for paths in names.values() for p in paths)}
    order = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])
    held = F.when(F.col("rel_path").isin(*place), F.struct(order[F.col("rel_path")].alias("k"), F.coalesce("text", F.lit("")).alias("text")))
    per = files.select("task", held.alias("f")).groupBy("task").agg(F.array_sort(F.collect_list("f")).alias("f"))

    def of(paths: tuple[str, ...]) -> Column:
        return F.array_join(F.transform(F.filter("f", lambda f: f["k"].isin(*[place[p] for p in paths])), lambda f: f["text"]), "\n")

    return per.select("task", *[of(paths).alias(name) for name, paths in names.items()])


def opened(text: Column) -> Column:
    """Paths that a verifier opens, or names in quotes below one of the usual roots."""
    return F.array_distinct(F.concat(_all(text, r"open\(\s*['\"]([^'\"]+)['\"]"), _all(text, r"['\"](/(?:app|root|opt|data|var|srv|home|etc|usr|mnt|workspace)[^'\"]+)['\"]")))


def named_in(text: Column, path: Column) -> Column:
    """Whether an instruction, in lower case, names a path, its file name, or its stem of four letters or more."""
    base = F.lower(base_name(path))
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    return text.contains(base) | text.contains(F.lower(path)) | ((F.length(stem) > 3) & text.contains(stem))


def produced(text: Column, path: Column) -> Column:
    """Whether a reference writes the path, or its file name: as the target of a redirection, of tee or of open for writing."""
    before = lambda p: F.split(text, F.concat(F.lit(r"\Q"), p, F.lit(r"\E")), -1)

    def writes(pieces: Column) -> Column:
        return F.exists(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x: x.rlike(r"(?:>>?|\btee(?:\s+-a)?)\s*['\"]?[^\s'\"]*$")) | F.exists(F.zip_with(pieces, F.slice(pieces, 2, F.size(pieces)), lambda a, b: a.rlike(r"open\(\s*['\"][^'\"]*$") & b.rlike(r"^['\"]?\s*,\s*['\"][wax]")), lambda x: F.coalesce(x, F.lit(False)))

    return writes(before(path)) | writes(before(base_name(path)))


def leak_findings(files: DataFrame, instructions: DataFrame | None = None) -> DataFrame:
    """(task, area, severity, title, location, detail): one finding for a package's writes below /tests, one for those
    elsewhere, one for its reference, one for modes that guard nothing; details are the paths, sorted. ``instructions`` are
    those of the packages' Dockerfiles, where they are written already."""
    if instructions is None:
        with_checkpoints(files.sparkSession)
        instructions = docker_instructions(files).checkpoint()  # read five times below
    builds = build_texts(files, instructions)
    fate = survivors(build_writes(instructions, builds), removed(builds))
    tests = F.col("path").startswith("/tests/")
    fates = fate.groupBy("task").agg(
        F.collect_set(F.when(tests, F.col("path"))).alias("tests_all"),
        F.collect_set(F.when(tests & F.col("survives"), F.col("path"))).alias("tests_left"),
        F.collect_set(F.when(~F.col("path").rlike("^/tests(/|$)") & F.col("survives"), F.col("path"))).alias("baked"),
    )
    modes = builds.select("task", F.explode(_all(F.col("text"), r"\bchmod\s+(?:-[a-zA-Z]+\s+)*0?(?:400|000|440|040|200)\s+([^\s;&|]+)")).alias("path"))
    modes = modes.where(~F.col("path").rlike(r"/tests|\.truth")).where(base_name(F.col("path")).rlike(TRUTHY) | base_name(F.col("path")).rlike(GRADERISH)).groupBy("task").agg(F.collect_set("path").alias("guarded"))
    drops = instructions.where((F.col("instr") == "USER") & ~F.col("args").rlike(r"^root\b")).select("task").distinct()
    modes = modes.join(drops, "task", "left_anti")
    one = texts_of(files, verifier=(TEST_PY, TEST_SH), solve=(SOLVE,), told=("instruction.md",)).join(fates, "task", "left").join(modes, "task", "left")
    empty = F.array().cast("array<string>")
    one = one.select("task", *[F.coalesce(c, empty).alias(c) for c in ("tests_all", "tests_left", "baked", "guarded")], "verifier", "solve", F.lower("told").alias("told"))
    reads = F.filter(opened(F.col("verifier")), lambda p: ~p.rlike("^/(tests|tmp)"))
    one = one.withColumn("reads", reads).withColumn("read_names", F.transform("reads", base_name))

    told = lambda p: named_in(F.col("told"), p)
    truth = lambda p: base_name(p).rlike(TRUTHY)
    met = F.filter("baked", lambda p: F.array_contains("reads", p) | F.array_contains("read_names", base_name(p)))
    rerun = F.exists("met", lambda p: p.rlike(r"(?i)/mutated"))
    telling = F.filter("met", lambda p: truth(p) | ~(p.rlike(SOURCE_FILE) | p.rlike(INPUT_FOLDER) | p.rlike(SCRATCH_FOLDER) | p.rlike(GRADER_FOLDER)))
    one = one.withColumn("met", met).withColumn("telling", F.when(rerun, empty).otherwise(telling))
    one = one.withColumn("spec", F.filter("telling", lambda p: p.rlike(CONFIG_FILE) & ~truth(p))).withColumn("hard", F.array_except("telling", "spec")).withColumn("truths", F.filter("baked", truth))
    one = one.withColumn("tests_read", F.filter("tests_left", lambda p: F.col("verifier").contains(base_name(p))))
    used = F.filter("reads", lambda p: truth(p) & F.col("solve").contains(base_name(p)) & ~produced(F.col("solve"), p))
    one = one.withColumn("used", used).withColumn("untold", F.filter("used", lambda p: ~told(p)))

    def shown(c: str) -> Column:
        return F.array_join(F.array_sort(F.col(c)), ", ")

    def case(location: str, *rows: tuple[Column, str, str]) -> Column:
        out = F.lit(None)
        for when, title, paths in reversed(rows):
            out = F.when(when, F.struct(F.lit(title).alias("title"), F.lit(location).alias("location"), shown(paths).alias("detail"))).otherwise(out)
        return out

    some = lambda c: F.size(c) > 0
    found = F.array_compact(
        F.array(
            case(DOCKERFILE, (some("tests_all") & ~some("tests_left"), "tests-bake-removed", "tests_all"), (some("tests_read"), "tests-bake-verifier-reads", "tests_read"), (some("tests_left"), "tests-bake-unread", "tests_left")),
            case(DOCKERFILE, (some("hard") & F.forall("hard", told), "verifier-reads-instruction-input", "hard"), (some("hard"), "truth-baked-verifier-reads", "hard"), (some("spec"), "verifier-reads-config-spec", "spec"), (some("truths"), "truth-named-baked", "truths")),
            case(SOLVE, (some("untold"), "reference-solve-reads-truth", "untold"), (some("used"), "reference-reads-instruction-input", "used")),
            case(DOCKERFILE, (some("guarded"), "chmod-not-a-guard", "guarded")),
        )
    )
    return one.select("task", F.explode(found).alias("f")).select("task", F.lit("anti_cheat").alias("area"), F.lit("FAIL").alias("severity"), "f.title", "f.location", "f.detail")
