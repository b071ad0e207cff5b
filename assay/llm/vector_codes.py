"""Product codes for vectors: exact nearest entries of distinct parts, found along a lexicographic trie.

Vectors become whole numbers and are cut into equal consecutive parts. The distinct parts of a position, with their
counts, are written once in lexicographic order. A walk goes down the trie of these parts depth first: a node holds the
squared distances of its prefix to all entries of the codebook, a child adds one dimension to its parent's, so common
prefixes are added once. A path without further branches is one edge, whose distances come from one product. Sorted parts
are walked in blocks: the nodes of a depth are one matrix, and the path that is still open at a block's end is carried
over. Leaves take the nearest entry and add their counts and weighted components to its sums.

A round is one pass over the distinct parts; tasks add up their own leaves and the driver gets positions times entries
rows. The last walk goes over the vectors where they lie, by the tries of their batches, so no vector is shuffled.

Defined results: vectors that are null or hold a null or non-finite component are left out, as are those whose length is
not the commonest (the smaller among equals) or, if that is no multiple of the number of parts, all. Rows that repeat an
id are vectors each; a null id is a vector and last in the codebooks' start, equal ids go by their components. With fewer
vectors than entries a codebook has that many. Components beyond the range of exact 64-bit distances raise an error.
Other columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.centroids import added
from assay.llm.store import Scratch
from assay.llm.vectors import binary, finite, rows, whole

#: Leaves of a block, whose distances to all entries are in memory together.
BLOCK = 2048
#: Most labels whose sums are broadcast, at some 50 bytes each.
BROADCAST_LABELS = 200_000
#: Parts are stored as big-endian numbers above this offset, so that their bytes sort like their components.
OFFSET = 1 << 62


def to_bytes(part: np.ndarray) -> pa.Array:
    return binary(part + OFFSET, ">u8")


def from_bytes(column: pa.Array) -> np.ndarray:
    return rows(column, ">u8").astype(np.int64) - OFFSET


class Walk:
    """A depth-first walk over ascending distinct parts, for one codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.path, self.last = entries, [np.zeros(len(entries), np.int64)], None
        self.peak = int(np.abs(entries).max(initial=0))

    def _edge(self, parts: np.ndarray, depth: int) -> np.ndarray:
        """Squared distances of the components from ``depth`` on to all entries."""
        e, x = self.entries[:, depth:], parts[:, depth:]
        most = max(self.peak, int(np.abs(x).max(initial=0)))
        if 4 * max(1, e.shape[1]) * most * most < 2**53:  # products of doubles are exact
            f, g = x.astype(float), e.astype(float)
            return ((f * f).sum(axis=1)[:, None] - 2 * (f @ g.T) + (g * g).sum(axis=1)).astype(np.int64)
        out = np.zeros((len(x), len(e)), np.int64)
        for d in range(e.shape[1]):
            out += (x[:, d, None] - e[None, :, d]) ** 2
        return out

    def block(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry (the lower index among equals) and squared distance of up to BLOCK parts, after those before."""
        n, dims = parts.shape
        shared = np.zeros(n + 1, np.int64)  # components shared with the part before; none beyond the block's end
        same = np.vstack([parts[:1] == self.last if self.last is not None else np.zeros((1, dims), bool), parts[1:] == parts[:-1]])
        shared[:n] = np.cumprod(same, axis=1).sum(axis=1)
        shared[0] = min(shared[0], len(self.path) - 1)
        alone = np.minimum(np.maximum(shared[:-1], shared[1:]), dims)  # from this depth on a leaf has its path for itself
        near, far = np.zeros(n, np.int64), np.zeros(n, np.int64)
        node, acc = np.zeros(n, np.int64), self.path[0][None, :]
        path = [self.path[0]]
        for depth in range(dims + 1):
            if depth:
                # a new node wherever the prefix of this depth is new; node 0 may be the carried one
                fresh = (shared[:n] < depth) & (alone >= depth)
                keep = bool(shared[0] >= depth)
                begins = np.flatnonzero(fresh)
                below = acc[node[begins]] + (parts[begins, depth - 1, None] - self.entries[None, :, depth - 1]) ** 2
                acc = np.vstack([self.path[depth][None, :], below]) if keep else below
                node = np.cumsum(fresh) - (0 if keep else 1)
                if alone[-1] >= depth:
                    path.append(acc[node[-1]])
            leaves = np.flatnonzero(alone == depth)
            if len(leaves):
                d = acc[node[leaves]] + self._edge(parts[leaves], depth)
                near[leaves], far[leaves] = d.argmin(axis=1), d.min(axis=1)
            if not (alone > depth).any():
                break
        self.path, self.last = path, parts[-1]
        return near, far

    def all(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done = [self.block(parts[lo : lo + BLOCK]) for lo in range(0, len(parts), BLOCK)]
        return np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, the place of each row among them, and their counts."""
    order = np.lexsort(parts.T[::-1])
    ranked = parts[order]
    new = np.ones(len(ranked), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place, np.diff(np.append(np.flatnonzero(new), len(ranked)))


def _packer(dims: int, scale: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), binary(whole(b.column(2), dims, scale), "<i8")], ["id", "label", "q"])

    return pack


def _cutter(n_parts: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = rows(b.column(0), "<i8")
            for pos, part in enumerate(np.split(q, n_parts, axis=1) if len(q) else []):
                some, _, n = _distinct(part)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), pos, np.int32)), to_bytes(some), pa.array(n)], ["pos", "part", "n"])

    return cut


def _adder(codebooks: list[np.ndarray]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = [Walk(c) for c in codebooks]
        n = [np.zeros(len(c), np.int64) for c in codebooks]
        s = [np.zeros(c.shape, np.int64) for c in codebooks]
        for b in batches:
            pos, weight = np.asarray(b.column(0)), np.asarray(b.column(2))
            for p in np.unique(pos).tolist():
                mine = np.flatnonzero(pos == p)
                parts = from_bytes(b.column(1).take(pa.array(mine)))
                near, _ = walks[p].all(parts)
                np.add.at(n[p], near, weight[mine])
                np.add.at(s[p], near, parts * weight[mine, None])
        for p in range(len(codebooks)):
            used = np.flatnonzero(n[p])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[p][used]), pa.array(list(s[p][used]), pa.list_(pa.int64()))], ["pos", "entry", "n", "s"])

    return add


def _coder(codebooks: list[np.ndarray]):
    digits = np.array([f"{i:02x}".encode() for i in range(256)])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            error, codes = np.zeros(b.num_rows, np.int64), []
            for c, part in zip(codebooks, np.split(rows(b.column(2), "<i8"), len(codebooks), axis=1), strict=True):
                some, place, _ = _distinct(part)
                near, far = Walk(c).all(some)
                codes.append(digits[near[place]])
                error += far[place]
            text = np.stack(codes, axis=1).view(f"S{2 * len(codebooks)}")[:, 0]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text.astype(str), pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    return code


def codes(vectors: DataFrame, n_parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every kept vector; ``entries`` is 256 at most."""
    if not 0 < entries <= 256:
        raise ValueError("a code byte holds 256 entries at most")
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    kind, label = vectors.schema[id_col].dataType.simpleString(), vectors.schema[label_col].dataType.simpleString()
    v = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("e")).where(finite(F.col("e")))
    common = v.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = common["d"] if common else 0
    if not dims or dims % n_parts:
        return spark.createDataFrame([], f"{id_col} {kind}, code string, error long, label_error long, codebooks_sha256 string")
    v = v.where(F.size("e") == dims)
    width = dims // n_parts
    packed = scratch.keep(v.mapInArrow(_packer(dims, scale), f"id {kind}, label {label}, q binary"), "packed")
    whole_e = F.transform("e", lambda x: F.floor(x * scale))
    first = [r["e"] for r in v.orderBy(F.col("id").asc_nulls_last(), whole_e).select("id", "e").limit(entries).collect()]
    codebooks = [c.copy() for c in np.split(whole(pa.array(first, pa.list_(pa.float64())), dims, scale), n_parts, axis=1)]
    parts = packed.select("q").mapInArrow(_cutter(n_parts), "pos int, part binary, n long").groupBy("pos", "part").agg(F.sum("n").alias("n"))
    parts = scratch.keep(parts.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "parts")
    for _ in range(rounds):
        for r in added(parts.mapInArrow(_adder([c.copy() for c in codebooks]), "pos int, entry int, n long, s array<long>"), ["pos", "entry"], width):
            codebooks[r["pos"]][r["entry"]] = [x // r["n"] for x in r["s"]]
    coded = scratch.keep(packed.mapInArrow(_coder(codebooks), f"id {kind}, label {label}, code string, error long"), "coded")
    scratch.drop("parts", "packed")
    by_label = scratch.keep(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    few = F.broadcast(by_label) if by_label.count() <= BROADCAST_LABELS else by_label
    digest = hashlib.sha256(",".join(str(x) for c in codebooks for x in c.reshape(-1).tolist()).encode()).hexdigest()
    out = coded.join(few, coded["label"].eqNullSafe(by_label["label"]))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
