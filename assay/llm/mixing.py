"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions alone.

Sources share the budget (the sum of all sizes) by weight; no source may be taken more than ``MAX_PASSES`` times over,
and what it cannot use goes to the others by weight, again and again until none is above. Every document, shuffled
within its source by a hash, gets for each pass a virtual finish time: the source's words up to and with it, over the
source's target. Sorted by that time over all sources, the mix is the longest prefix within the budget.

No source and no time range meets in one task: running sums are taken over hash ranges of about ``ROWS_A_RANGE`` rows,
then inside each, and the global cut over bins of virtual time, then inside the one bin that holds the cut.

Defined results: a null text has size 0. Documents of size 0 are never taken and sources without words have target 0.
Repeated rows are documents each. Null ids take part; ties in the shuffle go by id and then by text hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.store import Scratch

WORD = r"[^\x20\x09-\x0D]+"
MAX_PASSES = 3
ROWS_A_RANGE = 4096
BINS = 8192


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, ...) with weight and target: capped shares in closed form.

    With sources ordered by cap / weight, the first k are capped where the level that the rest then share lies below
    the next ratio. One row a source: the only ordering over sources there is.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sources.withColumn("weight", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).cast("double")).withColumn("cap", (F.col("source_size") * MAX_PASSES).cast("double"))
    w = w.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    w = w.withColumn("total", F.sum("source_size").over(everything).cast("double")).withColumn("weights", F.sum("weight").over(everything))
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    w = w.withColumn("level", left / rest)
    # the first source in this order whose ratio is not below the level sets it for all that follow
    w = w.withColumn("water", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    return w.select(*sources.columns, "weight", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix-1", key_col: str | None = None) -> DataFrame:
    """``docs`` ids with size, source_size, target, passes (how often the mix takes the document) and taken.

    ``key_col`` names a column with a number for each row, which comes along; rows of one id go by text hash and then by it.
    """
    key = [key_col] if key_col else []
    scratch = Scratch(docs.sparkSession)
    shuffle = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.when(F.col(id_col).isNull(), F.sha2(F.coalesce(text_col, F.lit("")), 256))).cast("binary"))
    base = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), shuffle.alias("h"), *key, *([F.xxhash64(text_col).alias("_text")] if key else []))
    base = scratch.keep(base, "sizes")

    per = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    # hash ranges of a source: as many as its rows ask for
    span = targets(per).select("source", "source_size", "target", "rows", F.ceil(F.col("rows") / ROWS_A_RANGE).alias("ranges"))
    span = scratch.keep(span, "sources")
    head = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    ranged = base.join(span.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "inner").drop("s", "rows").withColumn("range", F.floor(head * F.col("ranges") / F.lit(float(1 << 32))).cast("long"))

    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    sums = scratch.keep(sums.select(F.col("source").alias("s"), F.col("range").alias("r"), "before"), "ranges")
    inside = Window.partitionBy("source", "range").orderBy("h", F.col("id").asc_nulls_first(), *(["_text", *key] if key else [])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = ranged.withColumn("cum", F.sum("size").over(inside)).join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")), "inner").drop("s", "r")
    finish = F.transform(F.sequence(F.lit(0), F.lit(MAX_PASSES - 1)), lambda k: (k * F.col("source_size") + F.col("before") + F.col("cum")) / F.col("target"))
    queued = queued.select("id", *key, "size", "source_size", "target", "h", F.when((F.col("size") > 0) & (F.col("target") > 0), finish).otherwise(F.array().cast("array<double>")).alias("finish"))
    queued = scratch.keep(queued, "queue")
    scratch.drop("sizes")

    # times of a source run to 1 at its target; bins beyond 4 are one
    whole = span.agg(F.sum("source_size").alias("budget"), F.sum("rows").alias("rows")).first()
    budget, unit = whole["budget"] or 0, max(1024, (whole["rows"] or 0) // ROWS_A_RANGE)

    def bin_of(t: Column) -> Column:
        return F.floor(F.least(t, F.lit(4.0)) * unit)

    times = queued.select("size", "h", F.posexplode("finish").alias("pass", "t")).withColumn("bin", bin_of(F.col("t")))
    fill = times.groupBy("bin").agg(F.sum("size").alias("n"))
    run = fill.withColumn("upto", F.sum("n").over(Window.orderBy("bin")))
    cut = run.where(F.col("upto") > budget).agg(F.min("bin").alias("bin"), F.min(F.col("upto") - F.col("n")).alias("before")).first()
    last = None
    if cut["bin"] is not None:
        within = Window.orderBy("t", "h", "pass").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        edge = times.where(F.col("bin") == cut["bin"]).withColumn("sum", F.sum("size").over(within) + cut["before"])
        last = edge.where(F.col("sum") <= budget).agg(F.max(F.struct("t", "h", "pass")).alias("k")).first()["k"]

    def in_mix(t: Column, k: Column) -> Column:
        if cut["bin"] is None:
            return F.lit(True)
        if last is None:
            return bin_of(t) < cut["bin"]
        return (bin_of(t) < cut["bin"]) | (t < last["t"]) | ((t == last["t"]) & ((F.col("h") < last["h"]) | ((F.col("h") == last["h"]) & (k <= last["pass"]))))

    passes = F.size(F.filter("finish", in_mix)).cast("long")
    return queued.select(F.col("id").alias(id_col), *key, "size", "source_size", "target", passes.alias("passes"), (passes * F.col("size")).alias("taken"))
