"""Sinks: sorted reports as CSV, findings as NDJSON, and appends that a rerun does not repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, *order: str) -> None:
    """A CSV sorted over all its part files (range partitioned, so that no task sorts everything)."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def write_findings(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_new(df: DataFrame, path: str, keys: list[str]) -> int:
    """Append the rows whose key the Parquet table lacks; the number appended. One writer at a time: the check and the
    append are two steps."""
    spark = df.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)
    new = df.dropDuplicates(keys)
    if there:
        new = new.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti")
    before = spark.read.parquet(path).count() if there else 0
    new.write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - before


def merge_fields(old: DataFrame, new: DataFrame, key: str, fields: str = "fields") -> DataFrame:
    """Map column of ``old`` with the new entries over it; only rows that change are given."""
    j = old.join(new.select(key, F.col(fields).alias("_new")), key)
    kept = F.map_filter(fields, lambda k, _: ~F.map_contains_key(F.col("_new"), k))
    merged = F.map_concat(kept, "_new")
    changed = F.exists(F.map_entries("_new"), lambda e: ~F.element_at(F.col(fields), e["key"]).eqNullSafe(e["value"]))
    return j.where(changed).select(key, merged.alias(fields))


def write_defects(df: DataFrame, path: str) -> None:
    """A CSV of defect rows by priority (without one last), failures first, then task and area."""
    rows = df.withColumn("_p", F.when(F.col("priority") == "", "P9").otherwise(F.col("priority"))).withColumn("_w", F.col("severity") != "FAIL")
    rows.orderBy("_p", "_w", "task", "area").drop("_p", "_w").write.mode("overwrite").option("header", True).csv(path)


def write_gate(gated: DataFrame, path: str) -> None:
    """``quarantine`` (tab-separated task, layers, titles under a comment) and ``promoted`` (one task a line) below a folder."""
    lines = gated.where("not promoted").select(F.lit(1).alias("k"), F.concat_ws("\t", "task", "layers", "titles").alias("value"))
    head = gated.sparkSession.range(1).select(F.lit(0).alias("k"), F.lit("# task\tlayers\ttitles").alias("value"))
    head.unionByName(lines).orderBy("k", "value").select("value").write.mode("overwrite").text(f"{path}/quarantine")
    gated.where("promoted").select(F.col("task").cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(f"{path}/promoted")
