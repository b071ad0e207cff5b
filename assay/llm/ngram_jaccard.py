"""N-gram Jaccard join over a count-vector R-tree.

Every text becomes the set of its distinct word shingles. Shingles are hashed into groups:

* 256 fixed groups give the text's *point*, the number of its shingles in each group. The overlap of two sets is at
  most the sum of their coordinate minima, so a pair whose sum is below the overlap that the threshold needs is
  dropped unseen; the same bound against the corner of a leaf drops the leaf.
* groups whose number follows from the set's size give its *cells*. Two sets of J >= t differ in at most
  (1-t)/(1+t) of their summed sizes; with more groups than that, some group has the same content in both. Sets are
  therefore compared only where they share a (size family, group, content) cell, and none that links is missed. A bare
  R-tree over count vectors would be visited almost whole, as random texts of one length lie equally far apart.

Equal sets are one class, whatever their number. In a cell of up to ``PAIR_CELL`` classes all pairs meet; as most groups
of two linked sets agree, a pair goes on only if it shares as many cells as its sizes ask for. The classes of larger cells
form pools, one for each leader, the class of a cell that stands in most large cells:

* a pool of up to ``BLOCK`` classes meets in one task, packed in leaves. If many pairs are near, it gives out a forest of
  the most similar first, and once those are verified the pairs that still lie in different components.
* in a larger pool each set is replaced by its difference D to the leader's. Two sets differ in as many shingles as their
  differences do. A set joins the one with the smallest difference unseen where both differences together are small
  enough; every other linked pair shares so many elements of D that it shares one within a prefix of each, elements that
  the leader lacks first. Prefixes are cells again: small ones give pairs, large ones pools of the next level.
* after ``LEVELS`` levels a pool that is still large is compared in blocks, every two in a task.

The count-vector bound is weak for long texts, whose random counts are much alike. Each of them therefore has a *sketch* too,
the parity of its shingles in about as many groups as it has shingles: two sets differ in at least as many shingles as their
sketches differ in bits, so a pair whose sketches differ too much is dropped as well. What both bounds let through is
verified on the texts' own shingles.

Defined results: a null or empty text, or one of white space only, has no shingles and no link. Rows with a null id
are returned with a null component and link with nothing. Rows that repeat an id are returned each; they share its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.graph import components
from assay.llm.hashing import chunks, mix, shingle_sets
from assay.llm.store import Scratch

#: Groups of the count vectors.
DIMS = 256
PAIR_CELL = 8
#: Classes that meet in one task, points in a leaf, and levels of pools.
BLOCK, LEAF, LEVELS = 1024, 16, 4
#: Cells of a task that looks for those that stand in several rows, and those worth a task of their own.
CELLS, FEW_CELLS = 1 << 20, 1 << 16
#: Near pairs for each class of a pool above which the pool gives out a forest first.
MANY = 4
#: Shingles beyond which a set has a sketch (its counts average four or more), and bytes of sketches that are compared at a time.
SKETCHED, SKETCH_BYTES = 4 * DIMS, 1 << 22
#: Most ids that are broadcast: 8 bytes each, under 100 MB as a hash table.
BROADCAST_IDS = 3_000_000
#: Most bytes of leaders' texts that are broadcast.
BROADCAST_BYTES = 32_000_000
_U = np.uint64


def size_bands(t: Fraction, upto: int) -> np.ndarray:
    """Lower ends of size bands: sets that link lie in one band or in neighbours."""
    ends = [1]
    while ends[-1] <= upto:
        ends.append(int(ends[-1] / t) + 1)
    return np.array([*ends, int(ends[-1] / t) + 1, int(int(ends[-1] / t) / t) + 2], np.int64)


def family_shape(ends: np.ndarray, family: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Groups of a family (bands family - 1 and family), and how many of them may be empty in a set for free."""
    most = ends[family + 1] - 1
    d = (2 * most * (t.denominator - t.numerator)) // (t.denominator + t.numerator)
    spare = np.where(d > 0, 1 + d // 16, 0)
    return d + 1 + spare, spare


def _cells(val: np.ndarray, row: np.ndarray, sizes: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(set, cell key) of all sets in both their families, by set."""
    n = len(sizes)
    ends = size_bands(t, int(sizes.max(initial=1)))
    band = np.searchsorted(ends, sizes, "right") - 1
    content = mix(val ^ _U(0x5851F42D4C957F2D))
    owner_all, key_all = [], []
    for step in (0, 1):
        family = np.maximum(band, 0) + step
        g, spare = family_shape(ends, family, t)
        use = (sizes > 0) & (g > 1)
        g = np.where(use, g, 0)
        base = np.concatenate(([0], np.cumsum(g)))
        m = use[row]
        at = base[row[m]] + (mix(val[m] + family[row[m]].astype(np.uint64)) % g[row[m]].astype(np.uint64)).astype(np.int64)
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, at, content[m])
        count = np.bincount(at, minlength=base[-1])
        owner = np.repeat(np.arange(n), g)
        empties = np.bincount(owner, weights=count == 0, minlength=n)
        out = (count > 0) | (empties > spare)[owner]
        group = (np.arange(base[-1]) - base[:-1][owner]).astype(np.uint64)
        key = mix(mix(total + count.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) + mix(group * _U(0xC2B2AE3D27D4EB4F) + family[owner].astype(np.uint64)))
        owner_all.append(owner[out])
        key_all.append(key[out])
    owner, key = np.concatenate(owner_all), np.concatenate(key_all)
    order = np.argsort(owner, kind="stable")
    return owner[order], key[order].view(np.int64)


def _signer(width: int):
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for lo, hi in chunks(text):
                val, row, at = shingle_sets(text.slice(lo, hi - lo), width)
                n, sizes = hi - lo, np.diff(at)
                d1, d2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                np.add.at(d1, row, mix(val ^ _U(0xA5A5A5A5)))
                np.add.at(d2, row, mix(val ^ _U(0x5A5A5A5A5A5A)))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, n).cast(pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))], schema=schema)

    return sign, "id long, n_shingles long, d1 long, d2 long"


def _packed_cells(cell: np.ndarray, ids: np.ndarray, n: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Cells with their sets' ids and sizes, those of a bucket in one row; bytes of equal weight lie together, as they compress best so."""
    bucket = (cell.view(np.uint64) % _U(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    held, first = np.unique(bucket[order], return_index=True)
    cell, ids, n = cell[order], ids[order], n[order]
    packed = [np.split(x, first[1:]) for x in (cell, ids, n)]
    planes = [[v.view(np.uint8).reshape(len(v), -1).T.tobytes() for v in x] for x in packed]
    return pa.RecordBatch.from_arrays([pa.array(held), *(pa.array(x, pa.binary()) for x in planes)], ["bucket", "cell", "id", "n"])


def _unpacked(column, kind: str) -> np.ndarray:
    """The numbers of a column of ``_packed_cells``, one row after the other."""
    size = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(size, -1).T).view(kind).reshape(-1) for x in column]
    return np.concatenate(parts)


def _celler(width: int, t: Fraction, buckets: int):
    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            ids = np.asarray(b.column(0))
            for lo, hi in chunks(b.column(1)):
                val, row, at = shingle_sets(b.column(1).slice(lo, hi - lo), width)
                sizes = np.diff(at)
                owner, key = _cells(val, row, sizes, t)
                held.append((key, ids[lo:hi][owner], sizes[owner].astype(np.int32)))
                rows += len(key)
                if rows >= CELLS:
                    yield _packed_cells(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)
                    held, rows = [], 0
        if rows:
            yield _packed_cells(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)

    return cell, "bucket int, cell binary, id binary, n binary"


def cells_expected(shingles: int, t: Fraction) -> int:
    """About the cells of sets of so many shingles in all, in both families."""
    return int(4 * shingles * (1 - t) / (1 + t) / t)


def _sharer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the packed cells of a partition those that stand in several sets, by cell, and in how many."""
    held = [[_unpacked(b.column(k), kind) for k, kind in ((1, "<i8"), (2, "<i8"), (3, "<i4"))] for b in batches if b.num_rows]
    if not held:
        return
    cell, ids, n = (np.concatenate(x) for x in zip(*held, strict=True))
    del held
    order = np.argsort(cell)
    cell = cell[order]
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    m = np.diff(np.append(starts, len(cell)))
    m = np.repeat(m, m)
    several = np.flatnonzero(m > 1)
    for lo in range(0, len(several), 1 << 16):
        at = several[lo : lo + (1 << 16)]
        own = order[at]
        yield pa.RecordBatch.from_arrays([pa.array(cell[at]), pa.array(ids[own]), pa.array(n[own]), pa.array(m[at])], ["cell", "id", "n", "m"])


def cells_needed(a: np.ndarray, b: np.ndarray, t: Fraction) -> np.ndarray:
    """Least number of cells that two linked sets of sizes a and b share: groups less those that may differ or be empty."""
    ends = size_bands(t, int(max(a.max(initial=1), b.max(initial=1))))
    band_a, band_b = (np.searchsorted(ends, x, "right") - 1 for x in (a, b))
    differ = (a + b) * (t.denominator - t.numerator) // (t.denominator + t.numerator)
    need = np.zeros(len(a), np.int64)
    for step in (0, 1):
        family = np.minimum(band_a, band_b) + step
        both = (band_a == band_b) | ((step == 1) & (np.abs(band_a - band_b) == 1))
        g, spare = family_shape(ends, np.where(both, family, 0), t)
        need += np.where(both & (g > 1), np.maximum(g - spare - differ, 1), 0)
    # sets of other bands never link
    return np.where(np.abs(band_a - band_b) > 1, np.iinfo(np.int64).max, np.maximum(need, 1))


def _counter(t: Fraction):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            shared, a, b = (np.asarray(x.column(k)).astype(np.int64) for k in (2, 3, 4))
            yield x.select([0, 1]).filter(pa.array(shared >= cells_needed(a, b, t)))

    return count


def points(column) -> np.ndarray:
    """Points of a binary column as one matrix, as wide as their counts ask for."""
    if not len(column):
        return np.zeros((0, DIMS), np.uint16)
    out = np.stack([np.frombuffer(x, f"<u{len(x) // DIMS}") for x in column])
    return out.astype(np.uint16) if out.dtype == np.uint8 else out


def _enough(overlap, a, b, t: Fraction):
    """overlap / (a + b - overlap) >= t, in whole numbers."""
    return (t.numerator + t.denominator) * overlap >= t.numerator * (a + b)


def sketches(val: np.ndarray, row: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Of each set the parity of its shingles in groups by their low bits, a power of two of groups that is no less than its
    size; nothing of sets of up to ``SKETCHED`` shingles."""
    sizes = np.diff(at)
    groups = np.where(sizes > SKETCHED, np.int64(1) << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64), 0)
    m = groups[row] > 0
    val, row = val[m], row[m]
    base = np.concatenate(([0], np.cumsum(groups)))
    odd = np.bincount(base[row] + (val & (groups[row] - 1).astype(np.uint64)).astype(np.int64), minlength=base[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[lo:hi] for lo, hi in zip(base[:-1] // 8, base[1:] // 8, strict=True)]


def _folded(some: list[bytes], width: int) -> np.ndarray:
    """Sketches as rows of ``width`` bytes: groups that agree in their low bits are one."""
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, "<u8").reshape(-1, width // 8), axis=0) for x in some])


def differing(p: list[bytes], q: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair (p[i], q[j]) of sketches the bits that differ: no more than the shingles in which the sets differ."""
    width = np.minimum(np.array([len(x) for x in p], np.int64)[i], np.array([len(x) for x in q], np.int64)[j])
    out = np.zeros(len(width), np.int64)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        (a, i_a), (b, j_b) = np.unique(i[at], return_inverse=True), np.unique(j[at], return_inverse=True)
        a, b = _folded([p[k] for k in a], w), _folded([q[k] for k in b], w)
        step = max(1, SKETCH_BYTES // int(w))
        for lo in range(0, len(at), step):
            out[at[lo : lo + step]] = np.bitwise_count(a[i_a[lo : lo + step]] ^ b[j_b[lo : lo + step]]).sum(axis=1, dtype=np.int64)
    return out


def _near(differ, a, b, t: Fraction):
    """Whether sets of sizes a and b that differ in no fewer shingles may reach t, in whole numbers."""
    return (t.numerator + t.denominator) * differ <= (t.denominator - t.numerator) * (a + b)


def _bounder(t: Fraction):
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                x = b.slice(lo, 4096)
                p, q = points(x.column(2).to_pylist()), points(x.column(3).to_pylist())
                n, m, k = p.sum(axis=1, dtype=np.int64), q.sum(axis=1, dtype=np.int64), np.arange(x.num_rows)
                keep = _enough(np.minimum(p, q).sum(axis=1, dtype=np.int64), n, m, t)
                keep &= _near(differing(x.column(4).to_pylist(), x.column(5).to_pylist(), k, k), n, m, t)
                yield x.select([0, 1]).filter(pa.array(keep))

    return bound


def _verifier(width: int, t: Fraction):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(2)):
                x = b.slice(lo, hi - lo)
                av, _, aa = shingle_sets(x.column(2), width)
                bv, _, ba = shingle_sets(x.column(3), width)
                sizes_a, sizes_b = np.diff(aa), np.diff(ba)
                shared = np.array([len(np.intersect1d(av[aa[i] : aa[i + 1]], bv[ba[i] : ba[i + 1]], assume_unique=True)) for i in range(hi - lo)], np.int64)
                yield x.select([0, 1]).filter(pa.array(_enough(shared, sizes_a, sizes_b, t) & (shared > 0)))

    return verify


def leaf_join(p: np.ndarray, q: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pairs of p and q that the bound lets through, and the bound: q packed in leaves by size, leaf corners first,
    points second."""
    np_, nq = p.sum(axis=1, dtype=np.int64), q.sum(axis=1, dtype=np.int64)
    order, by_size = np.lexsort((q[:, 0], nq)), np.argsort(np_, kind="stable")
    p, np_ = p[by_size], np_[by_size]
    # sums of minima are no larger than the sizes
    wide, kind = (np.uint16 if n < 1 << 16 else np.uint32 for n in (np_.max(initial=0), min(np_.max(initial=0), nq.max(initial=0))))
    left, right, most = [], [], []
    for lo in range(0, len(order), LEAF):
        leaf = order[lo : lo + LEAF]
        corner, least, largest = q[leaf].max(axis=0), nq[leaf[0]], nq[leaf[-1]]
        # sizes alone rule out sets below t of the leaf's least or beyond 1 / t of its largest
        first, last = np.searchsorted(np_, -(-least * t.numerator // t.denominator)), np.searchsorted(np_, largest * t.denominator // t.numerator, "right")
        near = first + np.flatnonzero(_enough(np.minimum(p[first:last], corner).sum(axis=1, dtype=wide).astype(np.int64), np_[first:last], least, t))
        if len(near):
            low = np.minimum(p[near][:, None, :], q[leaf][None, :, :]).sum(axis=2, dtype=kind).astype(np.int64)
            i, j = np.nonzero(_enough(low, np_[near][:, None], nq[leaf][None, :], t))
            left.append(by_size[near[i]])
            right.append(leaf[j])
            most.append(low[i, j])
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else none for x in (left, right, most))


def _pointer(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                val, row, at = shingle_sets(b.column(1).slice(lo, hi - lo), width)
                n = hi - lo
                point = np.bincount(row * DIMS + (val >> _U(56)).astype(np.int64), minlength=n * DIMS).reshape(n, DIMS)
                point = pa.array([x.astype(np.min_scalar_type(x.max())).tobytes() for x in point], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, n), point, pa.array(sketches(val, row, at), pa.binary())], ["id", "point", "sketch"])

    return make, "id long, point binary, sketch binary"


def forest(a: np.ndarray, b: np.ndarray, rank: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Numbers of those pairs (a, b) that make a forest over the parts, by falling rank: each part in turn takes its
    highest pair that leaves it."""
    kept, part = [], np.unique(part, return_inverse=True)[1]
    left = np.flatnonzero(part[a] != part[b])
    place = np.empty(len(a), np.int64)
    place[np.lexsort((b, a, -rank))] = np.arange(len(a))
    while len(left):
        best = np.full(part.max() + 1, len(a), np.int64)
        np.minimum.at(best, part[a[left]], place[left])
        np.minimum.at(best, part[b[left]], place[left])
        taken = left[(best[part[a[left]]] == place[left]) | (best[part[b[left]]] == place[left])]
        kept.append(taken)
        # the lowest part that a part reaches over the pairs taken
        low = np.arange(len(best))
        u, v = part[a[taken]], part[b[taken]]
        while True:
            m = np.minimum(low[u], low[v])
            before = low.copy()
            np.minimum.at(low, u, m)
            np.minimum.at(low, v, m)
            low = low[low]
            if (low == before).all():
                break
        part = low[part]
        left = left[part[a[left]] != part[b[left]]]
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def _block_joiner(t: Fraction, forest_first: bool):
    """Pairs of different components of a pool's two blocks (or one) that both bounds let through, and whether some were
    kept back: with ``forest_first`` a forest stands for more than ``MANY`` pairs a class."""

    def join(key, rows):
        import pandas as pd

        i, j = key[2], key[3]
        p, ids, part, own = points(rows["point"]), rows["id"].to_numpy(), rows["component"].to_numpy(), rows["own"].to_numpy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b, most = leaf_join(p[left], p[right], t)
        a, b = left[a], right[b]
        apart = (part[a] != part[b]) & ((a < b) if i == j else True)
        a, b, most = a[apart], b[apart], most[apart]
        n, sketch = p.sum(axis=1, dtype=np.int64), rows["sketch"].tolist()
        close = _near(differing(sketch, sketch, a, b), n[a], n[b], t)
        a, b, most = a[close], b[close], most[close]
        back = forest_first and len(a) > MANY * len(rows)
        if back:
            kept = forest(a, b, most / (n[a] + n[b]), part)
            a, b = a[kept], b[kept]
        a, b = ids[a], ids[b]
        out = pd.DataFrame({"level": np.full(len(a), key[0], np.int32), "pool": np.full(len(a), key[1], np.int64), "a": np.minimum(a, b), "b": np.maximum(a, b), "back": np.full(len(a), back)})
        return out.drop_duplicates()

    return join


def _differ(width: int, t: Fraction):
    """Size of a set, of its difference to the leader's, and as much of that as any prefix needs: added ones first."""
    schema = pa.schema([("pool", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("nd", pa.int32()), ("d", pa.list_(pa.int64()))])

    def diff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(2)):
                x = b.slice(lo, hi - lo)
                lead = x.column(3).dictionary_encode()
                lv, _, la = shingle_sets(lead.dictionary, width)
                val, _, at = shingle_sets(x.column(2), width)
                n = np.diff(at)
                nd, kept = [], []
                for k, i in enumerate(np.asarray(lead.indices)):
                    own, other = val[at[k] : at[k + 1]], lv[la[i] : la[i + 1]]
                    d = np.concatenate([np.setdiff1d(own, other, assume_unique=True), np.setdiff1d(other, own, assume_unique=True)])
                    nd.append(len(d))
                    kept.append(d[: int(n[k]) * (t.denominator - t.numerator) // t.numerator + 1].view(np.int64))
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(n.astype(np.int32)), pa.array(np.array(nd, np.int32)), pa.array(kept, pa.list_(pa.int64()))], schema=schema)

    return diff, "pool long, id long, n int, nd int, d array<long>"


def bounded_broadcast(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it has at most ``BROADCAST_IDS`` rows; beyond that Spark shuffles."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def pools_of(hot: DataFrame) -> DataFrame:
    """(pool, id): the classes of all cells (cell, id, m) whose leader is ``pool``, the class most often in large cells."""
    often = hot.groupBy("id").agg(F.sum("m").alias("often"))
    lead = hot.join(often, "id").groupBy("cell").agg(F.max_by("id", F.struct("often", F.xxhash64("id"), "id")).alias("pool"))
    return hot.select("cell", "id").join(lead, "cell").select("pool", "id").distinct()


def prefixes(diffs: DataFrame, t: Fraction, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(u, v) pairs that link for certain, and (cell, id, mask) of the prefixes of ``diffs``.

    With t = p / q, sets x and y link if and only if (p + q) |Dx ^ Dy| <= (q - p)(|x| + |y|). f = (p + q)|D| - (q - p)|x|;
    where f(x) + f(y) <= 0 they link unseen, and then either links with the set of the smallest f. Otherwise the common
    elements of Dx and Dy number (f(x) + f(y)) / 2(p + q) or more, and never fewer than |Dx| - |x|(q - p)/p.
    Masks: 1 loose, within the prefix for loose partners; 2 loose, beyond it; 4 joined with the smallest. A set's prefixes
    in all its pools are one, as they hold much the same elements.
    """
    p, q = t.numerator, t.denominator
    f = (F.lit(p + q) * F.col("nd") - F.lit(q - p) * F.col("n")).cast("long")
    diffs = diffs.withColumn("f", f)
    low = scratch.keep(diffs.groupBy("pool").agg(F.min("f").alias("low"), F.min_by("id", F.struct("f", "id")).alias("least")), "low")
    rows = diffs.join(bounded_broadcast(low), "pool").withColumn("sure", F.col("f") + F.col("low") <= 0)
    links = rows.where(F.col("sure") & (F.col("id") != F.col("least"))).select(F.col("id").alias("u"), F.col("least").alias("v"))

    def whole(x: Column) -> Column:
        return F.floor(x / F.lit(2 * (p + q))).cast("int")

    room = F.col("nd") - F.greatest(F.lit(1), F.col("nd") - F.floor(F.col("n") * F.lit(q - p) / F.lit(p)).cast("int")) + 1
    near = F.least(room, F.col("nd") - whole(F.col("f") - F.col("low")))
    far = F.least(room, F.col("nd") - F.greatest(F.lit(1), -whole(-F.col("f") - F.col("low"))) + 1)
    rows = rows.withColumn("near", F.greatest(near, F.lit(0))).withColumn("upto", F.when(F.col("sure"), F.col("near")).otherwise(F.greatest(far, F.lit(0))))
    mask = lambda i: F.when(F.col("sure"), 4).when(i < F.col("near"), 1).otherwise(2)
    marks = F.transform(F.slice("d", F.lit(1), F.col("upto")), lambda e, i: F.struct(e.alias("cell"), mask(i).alias("mask")))
    whole_sets = rows.select("id", marks.alias("marks")).groupBy("id").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    spread = whole_sets.select("id", F.explode("marks").alias("k")).select("id", "k.cell", "k.mask")
    return links, spread.groupBy("id", "cell").agg(F.bit_or("mask").alias("mask"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, threshold: Fraction = Fraction(9, 10)) -> DataFrame:
    """(id, n_shingles, component_id) of every row; rows link where Jaccard similarity >= threshold."""
    spark, t = docs.sparkSession, Fraction(threshold)
    scratch = Scratch(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sign, ddl = _signer(width)
    signed = scratch.keep(base.mapInArrow(sign, ddl), "signatures")

    # one class for each distinct set; copies collapse before the shuffle and have no cells
    some = signed.where("id is not null and n_shingles > 0")
    classes = scratch.keep(some.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "classes")
    others = scratch.keep(signed.where("id is not null").select("id").distinct().join(classes.select(F.col("rep").alias("id")), "id", "left_anti"), "others")

    expected = cells_expected(some.agg(F.sum("n_shingles")).first()[0] or 0, t)
    tasks = max(1, -(-expected // CELLS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), expected // FEW_CELLS))
    to_cells, ddl = _celler(width, t, tasks)
    cells = base.where("id is not null").join(bounded_broadcast(others), "id", "left_anti").mapInArrow(to_cells, ddl)
    shared = scratch.keep(cells.repartitionById(tasks, "bucket").mapInArrow(_sharer, "cell long, id long, n int, m long"), "shared")
    scratch.drop("others")

    def of_ids(ids: DataFrame) -> DataFrame:
        """The rows of a written table of distinct ids."""
        return base.join(bounded_broadcast(ids), "id", "left_semi")

    def verified(near: DataFrame, points: DataFrame | None = None) -> DataFrame:
        """(u, v): those of the pairs (a, b) whose sets reach the threshold, where there are points first by the bounds."""
        if points is not None:
            near = near.join(points.select(F.col("id").alias("a"), F.col("point").alias("pa"), F.col("sketch").alias("sa")), "a").join(points.select(F.col("id").alias("b"), F.col("point").alias("pb"), F.col("sketch").alias("sb")), "b")
            near = near.select("a", "b", "pa", "pb", "sa", "sb").mapInArrow(_bounder(t), "a long, b long")
        near = scratch.keep(near.distinct(), "near")
        wanted = scratch.keep(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
        # rows that repeat an id with other texts stand beside each other: a link of either counts for the id
        texts = of_ids(wanted).dropDuplicates(["id", "text"])
        full = near.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        links = scratch.keep(full.select("a", "b", "ta", "tb").mapInArrow(_verifier(width, t), "u long, v long"), "links")
        scratch.drop("near", "ids")
        return links

    # in a small cell every class meets every other; a pair with small cells alone is counted in all of them
    small = shared.where(F.col("m") <= PAIR_CELL)
    left, right = (small.select("cell", F.col("id").alias(x), F.col("n").alias(f"n{x}")) for x in ("a", "b"))
    counted = left.join(right, "cell").where("a < b").groupBy("a", "b", "na", "nb").agg(F.count("*").alias("k"))
    candidates = [scratch.keep(counted.select("a", "b", "k", "na", "nb").mapInArrow(_counter(t), "a long, b long"), "pairs")]

    # large cells give pools, large pools prefixes of differences, and those cells again
    hot, sure, pools = shared.where(F.col("m") > PAIR_CELL).select("cell", "id", "m"), [], []
    for level in range(LEVELS + 1):
        rows = pools_of(hot)
        size = rows.groupBy("pool").agg(F.count("*").alias("size"))
        rows = scratch.keep(rows.join(size, "pool").withColumn("level", F.lit(level)), "pools")
        large = rows.where((F.col("size") > BLOCK) & F.lit(level < LEVELS))
        pools.append(rows.where((F.col("size") <= BLOCK) | F.lit(level == LEVELS)))
        if large.isEmpty():
            break
        leaders = scratch.keep(large.select(F.col("pool").alias("id")).distinct(), "leaders")
        lead = scratch.keep(of_ids(leaders).groupBy(F.col("id").alias("pool")).agg(F.min("text").alias("lead")), "lead")
        if (lead.agg(F.sum(F.octet_length("lead"))).first()[0] or 0) <= BROADCAST_BYTES:
            lead = F.broadcast(lead)
        diff, ddl = _differ(width, t)
        texts = base.join(bounded_broadcast(scratch.keep(large.select("pool", "id"), "members")), "id").join(lead, "pool")
        diffs = scratch.keep(texts.select("pool", "id", "text", "lead").mapInArrow(diff, ddl), "diffs")
        links, spread = prefixes(diffs, t, scratch)
        sure.append(scratch.keep(links, "sure"))
        w = Window.partitionBy("cell")
        some = [F.count_if(F.col("mask").bitwiseAND(k) > 0).over(w).alias(n) for k, n in ((1, "near"), (3, "loose"), (4, "joined"))]
        spread = spread.select("cell", "id", "mask", F.count("*").over(w).alias("m"), *some)
        spread = spread.where("m > 1 and (near > 1 or (joined > 0 and loose > 0))").select("cell", "id", "mask", "m")
        spread = scratch.keep(spread, "spread")
        left, right = (spread.where(F.col("m") <= PAIR_CELL).select("cell", F.col("id").alias(x), F.col("mask").alias(f"m{x}")) for x in ("a", "b"))
        met = F.expr("(ma & mb & 1) > 0 or ((ma & 4) > 0 and (mb & 3) > 0) or ((mb & 4) > 0 and (ma & 3) > 0)")
        candidates.append(scratch.keep(left.join(right, "cell").where(F.col("a") < F.col("b")).where(met).select("a", "b").distinct(), "pairs"))
        hot = spread.where(F.col("m") > PAIR_CELL).select("cell", "id", "m")
        scratch.drop("leaders", "members", "diffs", "lead", "low")

    pairs, pool = (reduce(DataFrame.unionByName, x) for x in (candidates, pools))
    wanted = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(pool.select("id")).distinct(), "wanted")
    point, ddl = _pointer(width)
    point = scratch.keep(of_ids(wanted).mapInArrow(point, ddl), "points")
    edges = reduce(DataFrame.unionByName, [*sure, verified(pairs.distinct(), point)])
    found = components(edges, scratch, "first")
    scratch.drop("links", "pairs", "sure", "shared", "spread")

    # what is left to meet are pools that hold several components
    for forest_first in (True, False):
        parts = pool.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        several = parts.groupBy("level", "pool").agg(F.min("component").alias("lowest"), F.max("component").alias("highest")).where("lowest <> highest")
        parts = scratch.keep(parts.join(several.select("level", "pool"), ["level", "pool"], "left_semi"), "parts")
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        dealt = parts.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        at = ("level", "pool", "i", "j")
        dealt = dealt.select("level", "pool", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "component").join(point, "id")
        near = scratch.keep(dealt.groupBy(*at).applyInPandas(_block_joiner(t, forest_first), "level int, pool long, a long, b long, back boolean"), "met")
        links = verified(near.select("a", "b"))
        known = found.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v"))
        found = components(known.unionByName(links), scratch, "second" if forest_first else "third")
        pool = pool.join(scratch.keep(near.where("back").select("level", "pool").distinct(), "back"), ["level", "pool"], "left_semi")
        scratch.drop("links", "parts")
        if pool.isEmpty():
            break
    scratch.drop("pools", "points", "wanted", "met", "back")

    label = classes.select("d1", "d2", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    label = scratch.keep(label, "labels")
    scratch.drop("classes", "first", "second", "third")
    out = signed.join(label, ["d1", "d2"], "left")
    group = F.when(F.col("id").isNull(), F.lit(None).cast("long")).when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", group.alias("component_id"))
