"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of several tables cuts ``hashes`` random Gaussian projections of the unit vectors into cells of a fixed width. A
query visits the cells around its own in the order of the chance that a neighbour at distance R lies there (its
projections differ by N(0, R)), until the chances of a table sum to ``success``. R is the k-th neighbour distance in a
bounded sample, which overstates it. Candidates of all tables are merged and ranked by the exact cosine.

Cells meet in blocks of at most about ``BLOCK`` vectors and ``BLOCK`` queries: a hot cell becomes many tasks. Each
block gives out k rows a query, so no list of candidates is ever written.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component take no part, neither do
null ids; a query with fewer candidates than k gets all that its cells hold, and while a query has fewer than k it is
ranked against all rows in blocks. Vectors of a length other than the commonest one take no part. Ties go to the smaller id.
Rows that repeat an id are one candidate, by their best score; a query never finds its own id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import erf, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.store import Scratch

BLOCK = 4096
REACH = 3
SAMPLE = 2000


def planes(dims: int, tables: int, hashes: int, width: float, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(seed)
    return [(rng.standard_normal((dims, hashes)), rng.uniform(0, width, hashes)) for _ in range(tables)]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cell_key(cells: np.ndarray) -> np.ndarray:
    out = np.zeros(len(cells), np.int64)
    for k in range(cells.shape[1]):
        out = out * 1_000_003 + cells[:, k]
    return out


def _vectors(col) -> np.ndarray:
    return np.frombuffer(b"".join(col), "<f8").reshape(len(col), -1)


def _indexer(spec, width: float):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column(1)
            x = unit(_vectors(raw.to_pylist()))
            for t, (a, shift) in enumerate(spec):
                key = cell_key(np.floor((x @ a + shift) / width).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(key), b.column(0), raw], ["t", "cell", "id", "vec"])

    return index


def probe_cells(x: np.ndarray, a: np.ndarray, shift: np.ndarray, width: float, radius: float, success: float) -> Iterator[tuple[int, np.ndarray]]:
    """Cells of each unit vector by falling chance, up to ``success`` in sum or all within ``REACH`` steps."""
    steps = np.array(list(product(range(-REACH, REACH + 1), repeat=a.shape[1])), np.int64)
    phi = np.vectorize(lambda z: 0.5 * (1 + erf(z / sqrt(2))))
    p = x @ a + shift
    home = np.floor(p / width).astype(np.int64)
    edges = phi((home[:, :, None] * width + np.arange(-REACH, REACH + 2) * width - p[:, :, None]) / radius)
    chance = np.diff(edges, axis=2)
    for i in range(len(x)):
        c = np.ones(len(steps))
        for m in range(a.shape[1]):
            c = c * chance[i, m, steps[:, m] + REACH]
        order = np.argsort(-c, kind="stable")
        n = int(np.searchsorted(np.cumsum(c[order]), success)) + 1
        yield i, cell_key(home[i] + steps[order[:n]])


def _prober(spec, width: float, radius: float, success: float):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                x = unit(_vectors(part.column(1).to_pylist()))
                for t, (a, shift) in enumerate(spec):
                    for i, keys in probe_cells(x, a, shift, width, radius, success):
                        n = len(keys)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), pa.array(keys), pa.array([part.column(0)[i].as_py()] * n, pa.int64()), pa.array([part.column(1)[i].as_py()] * n, pa.binary())], ["t", "cell", "id", "vec"])

    return probe


def best_by_id(s: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The best score of every distinct id in each row of scores."""
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
    return s if len(starts) == len(ids) else np.maximum.reduceat(s[:, order], starts, axis=1)


def best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest of each query in a block: a product finds them with a margin, the exact measure ranks them."""
    qn, xn = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    out = []
    for lo in range(0, len(q), 256):
        s = (q[lo : lo + 256] @ x.T) / qn[lo : lo + 256, None] / xn
        s[q_ids[lo : lo + 256, None] == ids[None, :]] = -np.inf
        one = best_by_id(s, ids)
        kth = np.partition(one, -k, axis=1)[:, -k] if one.shape[1] > k else np.full(len(s), -np.inf)
        i, j = np.nonzero((s >= kth[:, None] - 1e-9) & np.isfinite(s))
        exact = (q[lo + i] * x[j]).sum(axis=1) / (qn[lo + i] * xn[j])
        f = pd.DataFrame({"query_id": q_ids[lo + i], "vec_id": ids[j], "score": exact})
        f = f.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).drop_duplicates(["query_id", "vec_id"])
        out.append(f.groupby("query_id", sort=False).head(k))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _block_ranker(k: int):
    def rank(key, left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return best(left["id"].to_numpy(), _vectors(left["vec"]), right["id"].to_numpy(), _vectors(right["vec"]), k)

    return rank


def _pack():
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            flat = np.asarray(lists.flatten(), dtype="<f8")
            n = b.num_rows
            if n:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in flat.reshape(n, -1)], pa.binary()), b.column(2)], ["id", "vec", "q"])

    return pack


def _blocks(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))


def _ranked(queries: DataFrame, rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Blockwise ranking of the queries against the rows that share ``keys``."""
    n_rows = _blocks(rows, keys).withColumnRenamed("blocks", "rb")
    n_q = _blocks(queries, keys).withColumnRenamed("blocks", "qb")
    # a row a cell, however many vectors: sent to the tasks, vectors stay where they are until they meet
    grid = F.broadcast(n_rows.join(n_q, keys))

    def put(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col({"i": "qb", "j": "rb"}[own])).cast("int").alias(own)
        copies = F.explode(F.sequence(F.lit(0), F.col({"i": "qb", "j": "rb"}[other]) - 1)).alias(other)
        return df.join(grid, keys).select(*keys, "id", "vec", mine, copies)

    at = [*keys, "i", "j"]
    schema = "query_id long, vec_id long, score double"
    return put(queries, "i", "j").groupBy(*at).cogroup(put(rows, "j", "i").groupBy(*at)).applyInPandas(_block_ranker(k), schema)


def sample(rows: DataFrame) -> list:
    """The SAMPLE rows of lowest hash. Rows beyond a bound that leaves twice as many on average never leave their tasks, so
    that what reaches the driver doesn't grow with the number of partitions."""
    h = F.xxhash64("id")
    bound = -(2**63) + 2**64 * 2 * SAMPLE // max(rows.count(), 2 * SAMPLE + 1)
    low = rows.where(h <= F.lit(bound)).orderBy(h, "id").limit(SAMPLE).collect()
    return low if len(low) == SAMPLE else rows.orderBy(h, "id").limit(SAMPLE).collect()


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = 2, hashes: int = 4, width: float = 1.5, success: float = 0.78, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that ``is_query``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("e"), F.coalesce(is_query, F.lit(False)).alias("q"))
    sound = F.col("id").isNotNull() & (F.size("e") > 0) & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("e", lambda x: x != 0)
    v = v.where(sound)
    dims = v.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v = v.where(F.size("e") == dims["d"])
    packed = scratch.keep(v.select("id", "e", "q").mapInArrow(_pack(), "id long, vec binary, q boolean"), "vectors")
    queries, rows = packed.where("q").select("id", "vec"), packed.select("id", "vec")

    # bounded sample: the k-th nearest distance among SAMPLE rows is not below that among all
    some = sample(rows)
    x = unit(np.frombuffer(b"".join(r["vec"] for r in some), "<f8").reshape(len(some), -1))
    own = np.array([r["id"] for r in some], np.int64)
    s = x[:200] @ x.T
    s[own[:200, None] == own[None, :]] = -1
    s = best_by_id(s, own)
    kth = np.sort(s, axis=1)[:, -min(k, s.shape[1] - 1)] if s.shape[1] > 1 else np.zeros(1)
    radius = float(np.sqrt(np.maximum(2 - 2 * np.median(kth), 1e-4)))
    spec = planes(dims["d"], tables, hashes, width, seed)

    ddl = "t int, cell long, id long, vec binary"
    index = scratch.keep(rows.mapInArrow(_indexer(spec, width), ddl), "index")
    probes = scratch.keep(queries.repartition(F.col("id")).mapInArrow(_prober(spec, width, radius, success), ddl), "probes")
    found = scratch.keep(_ranked(probes, index, ["t", "cell"], k), "found")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # queries whose cells held too few rows are ranked against all
    have = merged.groupBy("query_id").agg(F.count("*").alias("n"))
    short = queries.join(have.where(F.col("n") >= k).select(F.col("query_id").alias("id")), "id", "left_anti")
    short = scratch.keep(short, "short")
    if not short.isEmpty():
        one = [c.withColumn("all", F.lit(0)) for c in (short, rows)]
        merged = merged.unionByName(_ranked(*one, ["all"], k)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
