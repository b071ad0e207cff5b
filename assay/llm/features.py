"""Hashed text features for the classifiers, and the bounded samples they are fitted on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.hashing import _LOWER, _SPACE, mix, range_hash, string_bytes, word_spans

_U = np.uint64
#: Parts in which a stratum is ranked first.
SAMPLE_PARTS = 256


def crc_part(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, longer by underscores where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def bounded_sample(rows: DataFrame, key: str, most: int, strata: str) -> DataFrame:
    """At most ``most`` rows of each stratum, by a fixed hash order of the key: the same rows in every run."""
    order = (F.xxhash64(F.lit(7), key), F.col(key))
    # first within hash parts of a stratum, so that no task ranks all its rows
    parts = Window.partitionBy(strata, F.pmod(F.xxhash64(key), F.lit(SAMPLE_PARTS))).orderBy(*order)
    some = rows.withColumn("__n", F.row_number().over(parts)).where(F.col("__n") <= most)
    return some.withColumn("__n", F.row_number().over(Window.partitionBy(strata).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def ngram_ids(arr: pa.Array, sizes: tuple[int, ...], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every byte n-gram of the lower-cased texts, white space as one kind of blank, and bytes a row.

    n-grams do not cross the ends of a text; a text shorter than n has none of that length.
    """
    raw, offs = string_bytes(arr)
    b = _LOWER[raw].astype(np.uint32)
    b[_SPACE[raw]] = 32
    n_bytes = np.diff(offs)
    owner = np.repeat(np.arange(len(n_bytes)), n_bytes)
    ids, rows = [], []
    value = np.zeros(len(b), np.uint64)
    for n in range(1, max(sizes, default=0) + 1):
        if n > len(b):
            break
        value = value[: len(b) - n + 1] * _U(257) + b[n - 1 :].astype(np.uint64) + _U(1)
        if n in sizes:
            inside = owner[: len(value)] == owner[n - 1 :]
            h = mix(value + _U(n << 48))[inside] % _U(dims)
            ids.append(h.astype(np.int64))
            rows.append(owner[: len(value)][inside])
    none = np.zeros(0, np.int64)
    return (np.concatenate(ids), np.concatenate(rows), n_bytes) if ids else (none, none, n_bytes)


def word_feature_ids(arr: pa.Array, dims: int, prefixes: tuple[int, ...] = (4, 5, 6)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every word without outer punctuation and of its prefixes, and words a row."""
    raw, offs = string_bytes(arr)
    low = _LOWER[raw]
    punct = ~(((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128))
    # a word here is a run of letters, digits and bytes beyond ASCII
    masked = raw.copy()
    masked[punct] = 32
    s, e, at = word_spans(masked, offs)
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(at))
    ids, rows = [range_hash(low, s, e) % _U(dims)], [owner]
    for n in prefixes:
        long = e - s > n
        ids.append(mix(range_hash(low, s[long], s[long] + n) + _U(n)) % _U(dims))
        rows.append(owner[long])
    return np.concatenate(ids).astype(np.int64), np.concatenate(rows), np.diff(at)
