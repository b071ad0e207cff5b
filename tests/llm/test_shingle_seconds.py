"""What the n-gram join's time goes by: no sort of all rows of a chunk, no points compared that sizes rule out, cells in tasks of bounded size."""

from fractions import Fraction

import numpy as np
import pyarrow as pa

from assay.llm import hashing as H
from assay.llm import ngram_jaccard as N


def test_long_rows_are_sorted_where_they_lie(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [None, "", "one", "one two"] + [" ".join(f"w{x}" for x in rng.integers(0, 40, n)) for n in rng.integers(0, 300, 200)]
    sorted_ = []
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorted_.append(len(keys[0])) or lexsort(keys))
    val, row, at = H.shingle_sets(pa.array(texts), 3)
    h, words = H.word_hashes(pa.array(texts))
    factors = H.mix(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)
    for k in range(len(texts)):
        own = h[words[k] : words[k + 1]]
        want = {int(H.mix(own[i] * factors[0] + own[i + 1] * factors[1] + own[i + 2] * factors[2])) for i in range(len(own) - 2)}
        if len(own) >= 3:
            assert val[at[k] : at[k + 1]].tolist() == sorted(want)
        else:
            assert at[k + 1] - at[k] == (len(own) > 0)
    assert sum(sorted_) < len(row) / 10


def test_sizes_rule_points_out_before_they_are_compared(monkeypatch):
    rng = np.random.default_rng(2)
    p = np.concatenate([rng.poisson(mean, (50, N.DIMS)) for mean in (4, 8, 16, 32, 64, 128)]).astype(np.uint16)
    p = np.concatenate([p, p[::7]])
    met, enough = [], N._enough
    monkeypatch.setattr(N, "_enough", lambda overlap, *rest: met.append(np.size(overlap)) or enough(overlap, *rest))
    i, j, most = N.leaf_join(p, p, Fraction(8, 10))
    low = np.minimum(p[:, None, :], p[None, :, :]).sum(axis=2, dtype=np.int64)
    n = p.sum(axis=1, dtype=np.int64)
    want = np.nonzero(enough(low, n[:, None], n[None, :], Fraction(8, 10)))
    assert sorted(zip(i.tolist(), j.tolist(), most.tolist(), strict=True)) == sorted(zip(want[0].tolist(), want[1].tolist(), low[want].tolist(), strict=True))
    # every other call compares points with a leaf's corner
    assert sum(met[::2]) < len(p) * len(p) / N.LEAF / 4


def test_cells_of_several_rows():
    rng = np.random.default_rng(3)
    cell, ids, n = rng.integers(-300, 300, 500), np.arange(500), rng.integers(1, 9, 500).astype(np.int32)
    parts = [N._packed_cells(*(x[lo : lo + 70] for x in (cell, ids, n)), 5) for lo in range(0, 500, 70)]
    assert max(b.num_rows for b in parts) == 5
    got = [r for b in N._sharer(iter(parts)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    count = {c: int((cell == c).sum()) for c in cell.tolist()}
    want = [(c, i, k, count[c]) for c, i, k in zip(cell.tolist(), ids.tolist(), n.tolist(), strict=True) if count[c] > 1]
    assert sorted(got) == sorted(want) and want
    assert list(N._sharer(iter([]))) == []
