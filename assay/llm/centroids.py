"""Exact Lloyd clustering of whole-number vectors, centroids filtered by n-simplex projection.

The squared distances of each vector to a few pivots are computed once and kept beside it. With the pivots' own distances
they place the vector as the apex of a simplex: coordinates in the pivots' flat and a height above it. The Euclidean
distance of two apexes is a lower bound of the true distance, and that with the heights on opposite sides an upper one.
A round places the centroids likewise, keeps for each vector those whose lower bound does not pass the smallest upper
bound (with a margin for rounding), and compares these alone in exact integers. The cut is safe at any data: where the
bounds tell nothing, all centroids are compared.

A round is one pass: tasks add up their own vectors by cluster, Spark adds up those sums, and k rows (the model) reach the
driver. No vector is shuffled, so copies and hot clusters cost nothing extra.

Defined results: vectors that are null, have other than ``dims`` components, or hold a null or non-finite one are left
out. Rows that repeat an id are vectors each; a null id is a vector, last among the seeds. Seeds of one hash go by their
components. With fewer vectors than k there are that many centroids, without any an empty table. Components beyond the
range of exact 64-bit distances raise an error. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.store import Scratch
from assay.llm.vectors import binary, finite, rows, whole

STEP = 2048
#: Share of the squared scale by which bounds may be off, far above the rounding of the coordinates.
SLACK = 1e-5
#: A pivot must stand above the flat of the others by this share of its squared distance to the first.
FLAT = 0.02


class Simplex:
    """Pivots and their base simplex; places points by their squared distances to the pivots."""

    def __init__(self, points: np.ndarray, most: int):
        self.pivots = points[:1]
        self.base = np.zeros((1, 0))
        for p in points[1:]:
            if len(self.pivots) >= most:
                break
            d2 = squared(self.pivots, p[None, :])[:, 0]
            x = self.apex(d2[None, :].astype(float))[0]
            if x[-1] ** 2 > FLAT * float(d2[0]):
                self.base = np.vstack([np.hstack([self.base, np.zeros((len(self.base), 1))]), x])
                self.pivots = np.vstack([self.pivots, p])

    def apex(self, d2: np.ndarray) -> np.ndarray:
        """Coordinates in the pivots' flat, then the height, of points with these squared distances to the pivots."""
        flat = self.base[1:]
        first = d2[:, :1]
        x = np.linalg.solve(flat, ((first + (flat * flat).sum(axis=1) - d2[:, 1:]) / 2).T).T if len(flat) else np.zeros((len(d2), 0))
        return np.hstack([x, np.sqrt(np.maximum(first - (x * x).sum(axis=1, keepdims=True), 0))])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to the few rows of ``b``."""
    out = np.empty((len(a), len(b)), np.int64)
    for j, y in enumerate(b):
        d = a - y
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def candidates(d2: np.ndarray, centres: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Which centroids may be nearest to each point: none that is nearest, ties included, is missing."""
    c2 = squared(centres, simplex.pivots).astype(float)
    x, y = simplex.apex(d2.astype(float)), simplex.apex(c2)
    inside = ((x[:, None, :-1] - y[None, :, :-1]) ** 2).sum(axis=2)
    low, high = inside + (x[:, None, -1] - y[None, :, -1]) ** 2, inside + (x[:, None, -1] + y[None, :, -1]) ** 2
    return low <= high.min(axis=1, keepdims=True) + SLACK * max(float(d2.max(initial=0)), float(c2.max(initial=0)))


def nearest(q: np.ndarray, d2: np.ndarray, centres: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid, the smaller number among equals, and its squared distance."""
    at, best = np.empty(len(q), np.int64), np.empty(len(q), np.int64)
    for lo in range(0, len(q), STEP):
        part = q[lo : lo + STEP]
        i, j = np.nonzero(candidates(d2[lo : lo + STEP], centres, simplex))
        diff = part[i] - centres[j]
        exact = np.full((len(part), len(centres)), np.iinfo(np.int64).max)
        exact[i, j] = np.einsum("ij,ij->i", diff, diff)
        at[lo : lo + STEP] = exact.argmin(axis=1)
        best[lo : lo + STEP] = exact.min(axis=1)
    return at, best


def _indexer(dims: int, scale: int, simplex: Simplex):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = whole(b.column(1), dims, scale)
            yield pa.RecordBatch.from_arrays([b.column(0), binary(q, "<i4" if abs(q).max(initial=0) < 2**31 else "<i8"), binary(squared(q, simplex.pivots), "<i8")], ["id", "q", "d2"])

    return index


def _points(b: pa.RecordBatch, q: str, d2: str, dims: int) -> tuple[np.ndarray, np.ndarray]:
    raw = b.column(b.schema.get_field_index(q))
    width = len(raw[0].as_py()) // dims
    wide = [len(x) != width * dims for x in raw.to_pylist()]
    if any(wide):  # batches of both widths met in one
        x = np.stack([np.frombuffer(v, "<i4" if len(v) == 4 * dims else "<i8").astype(np.int64) for v in raw.to_pylist()])
    else:
        x = rows(raw, f"<i{width}").astype(np.int64)
    return x, rows(b.column(b.schema.get_field_index(d2)), "<i8")


def _adder(dims: int, centres: np.ndarray, simplex: Simplex):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(len(centres), np.int64), np.zeros(centres.shape, np.int64)
        for b in batches:
            if b.num_rows:
                q, d2 = _points(b, "q", "d2", dims)
                at, _ = nearest(q, d2, centres, simplex)
                n += np.bincount(at, minlength=len(centres))
                np.add.at(s, at, q)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(list(s[used]), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    return add


def _assigner(dims: int, centres: np.ndarray, simplex: Simplex):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at, d = nearest(*_points(b, "q", "d2", dims), centres, simplex)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at.astype(np.int32)), pa.array(d)], ["id", "cluster", "distance"])

    return assign


def added(parts: DataFrame, keys: list[str], dims: int) -> list:
    """Sums by ``keys`` of rows (n, s array of ``dims`` sums): as many rows as there are keys."""
    sums = F.array(*[F.sum(F.col("s")[i]) for i in range(dims)])
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), sums.alias("s")).collect()


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, pivots: int = 12, seed: str = "1", id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("e")).where((F.size("e") == dims) & finite(F.col("e")))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    whole_e = F.transform("e", lambda x: F.floor(x * scale))
    first = [r["e"] for r in v.orderBy(order.asc_nulls_last(), whole_e).limit(k).collect()]
    result = f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    centres = whole(pa.array(first, pa.list_(pa.float64())), dims, scale)
    simplex = Simplex(centres, pivots)
    index = scratch.keep(v.mapInArrow(_indexer(dims, scale, simplex), f"id {kind}, q binary, d2 binary"), "index")
    for _ in range(rounds):
        centres = centres.copy()
        for r in added(index.mapInArrow(_adder(dims, centres, simplex), "cluster int, n long, s array<long>"), ["cluster"], dims):
            centres[r["cluster"]] = [x // r["n"] for x in r["s"]]
    assigned = scratch.keep(index.mapInArrow(_assigner(dims, centres, simplex), f"id {kind}, cluster int, distance long"), "assigned")
    scratch.drop("index")
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    each = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centres))])
    digest = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for c in centres])
    return assigned.select(F.col("id").alias(id_col), "cluster", "distance", each[F.col("cluster")].alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), digest[F.col("cluster")].alias("centroid_sha256"))
