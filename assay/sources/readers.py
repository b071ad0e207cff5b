"""Sources: findings and attempt files, label tables, task trees, their metadata and Dockerfiles."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructType

FINDING = "task string, area string, severity string, title string, location string, detail string, fix string, layer string, dimension string, ref string"
ATTEMPT = "trajectory_id string, task_id string, task_name string, model string, status string, score double, tool_calls long, total_tokens long, time_elapsed double"
STEP = StructType().add("line", IntegerType()).add("instr", StringType()).add("args", StringType())
LABEL = "task string, is_defect string, expected_verdict string, expected_title string, kind string, source string, notes string"


def findings(spark: SparkSession, path: str) -> DataFrame:
    """Findings of JSON arrays, or of objects that hold one under ``findings``; rows need a task and an area."""
    raw = spark.read.schema(f"{FINDING}, findings array<struct<{_fields(FINDING)}>>").option("multiLine", True).json(path)
    own = F.array(F.struct(*[c.split(" ")[0] for c in FINDING.split(", ")]))
    out = raw.select(F.explode(F.coalesce("findings", own)).alias("f")).select("f.*")
    return out.where("task is not null and area is not null").na.fill({"severity": "PASS", "title": ""})


def _fields(ddl: str) -> str:
    return ", ".join(f"{a}:{b}" for a, b in (x.strip().split(" ") for x in ddl.split(",")))


def attempts(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Attempts of NDJSON; a bad line stops a strict read and is dropped otherwise."""
    return spark.read.schema(ATTEMPT).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a CSV with a header; rows whose task is blank or starts with # are comments."""
    rows = spark.read.schema(LABEL).option("header", True).csv(path)
    return rows.where((F.trim("task") != "") & ~F.trim("task").startswith("#")).withColumn("is_defect", F.lower(F.trim("is_defect")).isin("1", "true", "yes", "y"))


#: Most task roots that are broadcast, at some 200 bytes each.
BROADCAST_ROOTS = 200_000


def _named_roots(files: DataFrame) -> DataFrame:
    """(task, root): folders with a task.toml that lie in no other such folder; the lowest path of a name wins."""
    roots = files.where(F.col("path").endswith("/task.toml")).select(F.regexp_replace("path", "/task\\.toml$", "").alias("root"))
    above = roots.select("root", F.explode(_folders(F.col("root"))).alias("parent"))
    nested = above.join(roots.select(F.col("root").alias("parent")), "parent").select("root").distinct()
    outer = roots.join(nested, "root", "left_anti").withColumn("task", F.element_at(F.split("root", "/"), -1))
    return outer.groupBy("task").agg(F.min("root").alias("root"))


def _folders(path: Column) -> Column:
    """All folders above a path."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def task_files(spark: SparkSession, root: str) -> DataFrame:
    """(task, rel_path, size, text) of every file below a folder that holds task.toml and lies in no other such folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.where(~F.col("path").rlike(r"/(\.git|node_modules|__pycache__|tasks_cache)/"))
    roots = _named_roots(files.select("path"))
    small = roots.count() <= BROADCAST_ROOTS
    parents = files.withColumn("root", F.explode(_folders(F.col("path"))))
    found = parents.join(F.broadcast(roots) if small else roots, "root")
    return found.select("task", F.expr("substring(path, length(root) + 2)").alias("rel_path"), F.col("length").alias("size"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def flat_files(spark: SparkSession, root: str, name: str = "*") -> DataFrame:
    """(folder, file, text) of the files in the immediate folders below ``root``; equal names are kept each."""
    files = spark.read.format("binaryFile").load(f"{root}/*/{name}")
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def tab_lines(spark: SparkSession, path: str, columns: list[str], numbers: tuple[str, ...] = ()) -> DataFrame:
    """Columns of a tab-separated text: short lines give nulls, a number that is none gives 0, blank lines go."""
    parts = F.split(F.col("value"), "\t", -1)
    rows = spark.read.text(path).where(F.trim("value") != "")
    cols = [F.get(parts, F.lit(k)) for k in range(len(columns))]
    return rows.select(*[(F.coalesce(c.try_cast("long"), F.lit(0)) if n in numbers else c).alias(n) for n, c in zip(columns, cols, strict=True)])


def scored_files(spark: SparkSession, path: str, pattern: str = r"score_([0-9.]+?)\.json$") -> DataFrame:
    """(file, score, text) of text files whose name holds a score."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.read.option("wholetext", True).text(path).select(name.alias("file"), F.regexp_extract(name, pattern, 1).try_cast("double").alias("score"), F.col("value").alias("text"))


def exported_attempts(spark: SparkSession, path: str) -> DataFrame:
    """(batch, task, attempt, model, score) of an export: an object of batches, each with tasks that hold their attempts."""
    attempt = "id string, model string, score double"
    ddl = f"batches array<struct<name string, tasks array<struct<task string, attempts array<struct<{attempt}>>>>>>"
    raw = spark.read.schema(ddl).option("multiLine", True).json(path)
    tasks = raw.select(F.explode("batches").alias("b")).select(F.col("b.name").alias("batch"), F.explode("b.tasks").alias("t"))
    return tasks.select("batch", "t.task", F.explode("t.attempts").alias("a")).select("batch", "task", F.col("a.id").alias("attempt"), "a.model", "a.score")


def yaml_pairs(text: str | None) -> dict[str, str]:
    """Key -> value of a flat YAML subset: scalars, lists of scalars (one item a line), block texts; other lines are passed over."""
    out: dict[str, str] = {}
    key, block = "", False
    for line in (text or "").splitlines():
        if m := re.fullmatch(r"([A-Za-z_][\w-]*):\s*(.*?)\s*", line):
            key, value = m[1], _without_comment(m[2]).strip()
            block = value in ("|", ">", "|-", ">-")
            out[key] = "" if block else toml_value(value)
        elif key and block and (line.startswith("  ") or not line.strip()):
            out[key] += ("\n" if out[key] else "") + line[2:]
        elif key and (m := re.fullmatch(r"\s*-\s+(.*?)\s*", line)):
            out[key] += ("\n" if out[key] else "") + toml_value(_without_comment(m[1]))
    return out


@F.pandas_udf(MapType(StringType(), StringType()))
def parse_yaml(text: pd.Series) -> pd.Series:
    return text.map(yaml_pairs)


def toml_value(v: str) -> str:
    """A TOML scalar or flat list as JSON-like text; anything else as it stands."""
    v = v.strip()
    return v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'" else v


def _without_comment(line: str) -> str:
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c == "#":
            return line[:i]
    return line


def toml_pairs(text: str | None) -> dict[str, str]:
    """Dotted key -> value of a TOML subset; malformed lines are passed over and the last of equal keys counts."""
    out, section, pending = {}, "", ""
    for line in (text or "").splitlines():
        line = _without_comment(line).strip()
        if pending:
            line, pending = f"{pending} {line}", ""
        if not line:
            continue
        if m := re.fullmatch(r"\[+\s*([^\[\]]+?)\s*\]+", line):
            section = m[1]
        elif "=" in line:
            if line.count("[") > line.count("]"):
                pending = line
                continue
            key, value = line.split("=", 1)
            out[f"{section}.{key.strip()}" if section else key.strip()] = toml_value(value)
    return out


@F.pandas_udf(MapType(StringType(), StringType()))
def parse_toml(text: pd.Series) -> pd.Series:
    return text.map(toml_pairs)


def docker_steps(text: str | None) -> list[dict]:
    """Instructions of a Dockerfile, continuations folded: line number, instruction in upper case, arguments."""
    out, held, start = [], "", 0
    for k, line in enumerate((text or "").splitlines(), 1):
        bare = line.strip()
        if not held and (not bare or bare.startswith("#")):
            continue
        start = start or k
        held = f"{held} {bare}".strip()
        if held.endswith("\\"):
            held = held[:-1].rstrip()
            continue
        name, _, args = held.partition(" ")
        out.append({"line": start, "instr": name.upper(), "args": args.strip()})
        held, start = "", 0
    return out


@F.pandas_udf(ArrayType(STEP))
def parse_dockerfile(text: pd.Series) -> pd.Series:
    return text.map(docker_steps)

