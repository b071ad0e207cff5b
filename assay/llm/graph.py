"""Connected components of an edge table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.store import Scratch


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(id, component): every id that has an edge, with the smallest id of its component.

    ``edges`` has integer columns u and v, in either order, repeats allowed. Alternating large-star and small-star
    steps: each is one grouped minimum (combined before the shuffle) and one join, whose hubs adaptive execution splits.
    """
    cur = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    cur = scratch.keep(cur, f"{name}0")
    last, step = None, 0
    while True:
        seen = _print(cur)
        if seen == last or not seen[0]:
            break
        last = seen
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: neighbours below u, and u itself, all point at the lowest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        nxt = small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct()
        step += 1
        cur = scratch.keep(nxt, f"{name}{step}")
        scratch.drop(f"{name}{step - 1}")
    scratch.rename(f"{name}{step}", name)
    out = cur.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return out.unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
