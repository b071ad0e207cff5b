"""The bound of sketches: never above the true difference, and strong where count vectors of long texts are alike."""

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from assay.llm import ngram_jaccard
from assay.llm.hashing import shingle_sets


def word_texts(rng, sizes):
    return [" ".join(map(str, rng.integers(0, 1 << 40, n))) for n in sizes]


def pointed(texts, width):
    make = ngram_jaccard._pointer(width)
    make = make[0] if isinstance(make, tuple) else make
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
    return pa.Table.from_batches(list(make(iter([batch]))))


def test_sketches_never_differ_more_than_their_sets():
    rng = np.random.default_rng(3)
    texts = []
    for n in (2, 70, 1030, 1100, 2100, 4000):
        words = word_texts(rng, [n])[0].split()
        texts += [" ".join(words), " ".join(words[: int(0.9 * n)] + ["x"] * 3), " ".join(reversed(words))]
    val, row, at = shingle_sets(pa.array(texts), 3)
    sets = [set(val[at[k] : at[k + 1]].tolist()) for k in range(len(texts))]
    sketches = ngram_jaccard.sketches(val, row, at)
    assert [len(x) > 0 for x in sketches] == [len(x) > ngram_jaccard.SKETCHED for x in sets]
    i, j = (x.ravel() for x in np.indices((len(texts), len(texts))))
    got = ngram_jaccard.differing(sketches, sketches, i, j)
    true = np.array([len(sets[a] ^ sets[b]) for a, b in zip(i, j, strict=True)])
    assert (got <= true).all() and got[(i == 16) & (j == 17)][0] > 1000


@pytest.mark.parametrize("t", [Fraction(8, 10), Fraction(9, 10)])
def test_a_pool_of_long_texts_gives_out_linked_pairs_alone(t):
    rng = np.random.default_rng(8)
    passage = word_texts(rng, [300])[0]
    long = [f"{passage} {x}" for x in word_texts(rng, [30_000] * 6)]
    near = long[2].split()
    near[500:600] = word_texts(rng, [100])[0].split()
    rows = pointed([*long, " ".join(near)], 5).to_pandas().assign(component=range(7), own=0)
    got = ngram_jaccard._block_joiner(t, False)((0, 0, 0, 0), rows)
    assert list(zip(got["a"], got["b"], strict=True)) == [(2, 6)]
    # pairs of small cells go through the same bounds
    a, b = (x.ravel() for x in np.triu_indices(7, 1))
    cols = {k: [rows[c][x] for x in y] for k, c, y in (("pa", "point", a), ("pb", "point", b), ("sa", "sketch", a), ("sb", "sketch", b))}
    batch = pa.RecordBatch.from_pandas(pd.DataFrame({"a": a, "b": b} | cols), preserve_index=False)
    kept = pa.Table.from_batches(list(ngram_jaccard._bounder(t)(iter([batch])))).to_pylist()
    assert kept == [{"a": 2, "b": 6}]
