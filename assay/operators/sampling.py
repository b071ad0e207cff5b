"""Ranked choices and samples: one for each outcome, the first k, quotas, round-robin, even strides, precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.session import with_checkpoints


def first_of(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")


def one_per_outcome(attempts: DataFrame, score: Column, order: list[Column], most: int = 2) -> DataFrame:
    """Of each task the first failed and the first solved attempt, or its first one if it has neither; ``most`` at most."""
    s = F.coalesce(score.cast("double"), F.lit(0.0))
    kind = F.when(s == 0, 0).when(s == 1, 1)
    ranked = attempts.withColumn("_kind", kind).withColumn("_n", F.row_number().over(Window.partitionBy("task", "_kind").orderBy(*order)))
    task = Window.partitionBy("task")
    ranked = ranked.where("_n = 1").withColumn("_some", F.count("_kind").over(task)).where("_kind is not null or _some = 0")
    ranked = ranked.withColumn("_n", F.row_number().over(task.orderBy(F.col("_kind").asc_nulls_last()))).where(F.col("_n") <= most)
    return ranked.drop("_kind", "_n", "_some")


def quotas(df: DataFrame, band: str, wanted: dict[int, int], order: list[Column]) -> DataFrame:
    """As many rows of each band as its quota, by preference; bands without one are left out."""
    quota = F.create_map(*[x for b, n in wanted.items() for x in (F.lit(b), F.lit(n))])[F.col(band)]
    w = Window.partitionBy(band).orderBy(*order)
    return df.where(quota.isNotNull()).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= quota).drop("_k")


def round_robin(df: DataFrame, stratum: str, order: list[Column], k: int) -> DataFrame:
    """``k`` rows in turns over the strata, small strata first in each turn."""
    size = df.groupBy(stratum).agg(F.count("*").alias("_size"))
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy(*order))
    # no row beyond turn k can be among the first k
    ranked = df.withColumn("_turn", turn).where(F.col("_turn") <= k).join(size, stratum)
    return ranked.orderBy("_turn", "_size", stratum).limit(k).drop("_turn", "_size")


def every_nth(df: DataFrame, order: str, k: int) -> DataFrame:
    """``k`` rows evenly spaced in the order of a distinct column: numbers floor(i * n / k), or all rows if there are fewer.

    Numbers are counted within ranges of the order, so that no task holds all rows.
    """
    parts = df.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id())
    with_checkpoints(df.sparkSession)
    # written once, as ranges differ from run to run
    within = parts.withColumn("_i", F.row_number().over(Window.partitionBy("_part").orderBy(order))).checkpoint()
    sizes = within.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    i = F.col("_start") + F.col("_i") - 1
    # row i is taken where a multiple of total / k falls into it
    hit = (F.col("_total") <= k) | (F.floor((i * k + F.col("_total") - 1) / F.col("_total")) * F.col("_total") < (i + 1) * k)
    return within.join(F.broadcast(starts), "_part").join(F.broadcast(total)).where(hit).select(*df.columns)


def repeated(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` says; none for zero or null."""
    n = F.coalesce(times, F.lit(0))
    return df.select("*", F.explode(F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))).alias("copy"))


def first_source(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """The rows of the first source that has their key."""
    out = sources[0].withColumn("source_rank", F.lit(0))
    for k, s in enumerate(sources[1:], 1):
        out = out.unionByName(s.withColumn("source_rank", F.lit(k)), allowMissingColumns=True)
    return out.withColumn("_k", F.min("source_rank").over(Window.partitionBy(*keys))).where("source_rank = _k").drop("_k")


def override(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """``old`` with the value of ``new`` where that has the key and a value."""
    fresh = new.select(key, F.col(value).alias("_new"))
    return old.join(fresh, key, "left").withColumn(value, F.coalesce("_new", value)).drop("_new")


def by_id_or_name(left: DataFrame, right: DataFrame, id_col: str, name_col: str, value: str) -> DataFrame:
    """``left`` with ``value`` of ``right`` by id, else by name; of rows of one name the smallest value counts."""
    by_id = right.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(value).alias("_by_id"))
    by_name = right.where(F.col(name_col).isNotNull()).groupBy(name_col).agg(F.min(value).alias("_by_name"))
    return left.join(by_id, id_col, "left").join(by_name, name_col, "left").withColumn(value, F.coalesce("_by_id", "_by_name")).drop("_by_id", "_by_name")


def side_by_side(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """(label, left_n, left_share, right_n, right_share) over the labels of either side."""

    def hist(df: DataFrame, name: str) -> DataFrame:
        n = df.groupBy(label).agg(F.count("*").alias(f"{name}_n"))
        total = n.agg(F.sum(f"{name}_n").alias("t"))
        return n.join(F.broadcast(total)).select(label, f"{name}_n", (F.col(f"{name}_n") / F.col("t")).alias(f"{name}_share"))

    return hist(left, "left").join(hist(right, "right"), label, "full_outer").na.fill(0)
