"""Toxicity by cumulative-link ordinal regression over sparse text features.

Features are hashed words and word beginnings of the whole text; those that tell the labelled classes apart are kept,
by their counts of distinct texts in the sample. Grades run from 0 (not toxic) to 3: a toxic document's grade is the third of
the toxic sample in which its share of telling features lies. One weight vector serves all thresholds,
P(grade <= k) = sigmoid(theta_k - w.x), and the answer is the expected grade.

Fitted on a bounded sample: at most ``per_class`` labelled documents a class, picked by a hash of their id. Defined
results: null and empty texts have no features and get the severity of the thresholds alone; a text without features is
not toxic, and without any telling feature in the sample no text is. Labels that contradict
each other for one id count as toxic. Without labelled documents of both classes (empty tables among them) no text is
toxic and every severity is 0. Other columns of the tables are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.features import bounded_sample, word_feature_ids
from assay.llm.hashing import chunks

DIMS = 1 << 20
PER_CLASS = 3000
GRADES = 4
#: A feature is kept if chance does not explain it (standard errors between the classes) and it is commoner among toxic
#: documents; the regression weighs it.
MIN_Z, MIN_ODDS = 4.0, 3.0
PREFIXES = (4, 5, 6, 7, 8, 9, 10, 12)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class that hold each feature, summed over a part of the sample."""
    total = {}
    for b in batches:
        y = np.asarray(b.column(0))
        for lo, hi in chunks(b.column(1)):
            ids, rows, _ = word_feature_ids(b.column(1).slice(lo, hi - lo), DIMS, PREFIXES)
            code = np.unique(rows * DIMS + ids)
            for c in (0, 1):
                f, n = np.unique(code[y[lo + code // DIMS] == c] % DIMS, return_counts=True)
                for k, v in zip(f.tolist(), n.tolist(), strict=True):
                    total.setdefault(k, [0, 0])[c] += v
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.int64())], ["f", "n0", "n1"])


def sparse(arr: pa.Array, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, log count) of the kept features in each text, and words a text."""
    ids, rows, n_words = word_feature_ids(arr, DIMS, PREFIXES)
    there = np.zeros(DIMS, bool)
    there[kept] = True
    hit = np.flatnonzero(there[ids])
    at = np.searchsorted(kept, ids[hit])
    code, n = np.unique(rows[hit] * max(len(kept), 1) + at, return_counts=True)
    return code // max(len(kept), 1), code % max(len(kept), 1), np.log1p(n), n_words


class OrdinalModel:
    def __init__(self, kept: np.ndarray, w: np.ndarray, theta: np.ndarray, cut: float = 0.5):
        self.kept, self.w, self.theta, self.cut = kept, w, theta, cut

    def above(self, z: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.theta[None, :] - z[:, None], -500, 500)))

    def severity(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        row, col, val, _ = sparse(arr, self.kept)
        z = np.bincount(row, weights=self.w[col] * val, minlength=len(arr)) if len(row) else np.zeros(len(arr))
        p = self.above(z)
        return p.sum(axis=1), p[:, 0]


def fit_ordinal(x: np.ndarray | tuple, y: np.ndarray, weight: np.ndarray, grades: int = GRADES, l2: float = 1e-4, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and rising thresholds by full-batch Adam on the cumulative-link likelihood.

    ``x`` is a matrix, or its (row, column, value, columns).
    """
    row, col, val, n_cols = x if isinstance(x, tuple) else (*np.nonzero(x), x[np.nonzero(x)], x.shape[1])
    k = grades - 1
    par = np.zeros(n_cols + k)
    par[-k:] = [0.0] + [0.0] * (k - 1)  # first threshold, then log gaps
    m, v = np.zeros_like(par), np.zeros_like(par)
    sig = lambda t: 1 / (1 + np.exp(-np.clip(t, -500, 500)))
    for step in range(1, steps + 1):
        w, t = par[:-k], np.concatenate([par[-k:][:1], np.exp(par[-k:][1:])]).cumsum()
        z = np.bincount(row, w[col] * val, len(y))
        upper = np.where(y < k, sig(t[np.minimum(y, k - 1)] - z), 1.0)
        lower = np.where(y > 0, sig(t[np.maximum(y - 1, 0)] - z), 0.0)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = np.where(y < k, upper * (1 - upper), 0), np.where(y > 0, lower * (1 - lower), 0)
        gz = weight * (du - dl) / p  # derivative of -log p in z
        gt = np.zeros(k)
        np.add.at(gt, np.minimum(y, k - 1), -weight * du / p * (y < k))
        np.add.at(gt, np.maximum(y - 1, 0), weight * dl / p * (y > 0))
        tail = gt[::-1].cumsum()[::-1]  # a gap moves all thresholds above it
        gap = tail.copy()
        gap[1:] *= np.exp(par[-k:][1:])
        g = np.concatenate([np.bincount(col, gz[row] * val, n_cols) / len(y) + l2 * w, gap / len(y)])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return par[:-k], np.concatenate([par[-k:][:1], np.exp(par[-k:][1:])]).cumsum()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> OrdinalModel:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    known = known.groupBy("_id").agg(F.max((F.col("_label") > 0).cast("int")).alias("y"))
    chosen = F.broadcast(bounded_sample(known, "_id", per_class, "y"))  # bounded: per_class ids of either class
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).where("text is not null")
    rows = texts.join(chosen, F.col("_doc") == F.col("_id")).select("y", "text").repartition(16, F.xxhash64("text"))
    # a text counts once, so that its copies cannot make its words telling
    rows = rows.dropDuplicates(["y", "text"])
    both = rows.mapInArrow(_counts, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    n, shown = ({r["y"]: r["count"] for r in f.groupBy("y").count().collect()} for f in (chosen, rows))
    if not n.get(0) or not n.get(1) or not shown.get(0) or not shown.get(1):
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES - 1, np.inf), 0.5)
    d0, d1 = (max(shown.get(c, 0), 1) for c in (0, 1))
    p1, p0, p = F.col("n1") / d1, F.col("n0") / d0, (F.col("n0") + F.col("n1")) / (d0 + d1)
    z = (p1 - p0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / d1 + 1 / d0))
    telling = both.where("n1 >= 4").withColumn("z", z).where((F.col("z") >= MIN_Z) & (p1 >= MIN_ODDS * p0))
    top = sorted(telling.select("f").collect())  # bounded: DIMS buckets
    kept = np.array([r["f"] for r in top], np.int64)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                row, col, val, words = sparse(b.column(1).slice(lo, hi - lo), kept)
                cut = np.searchsorted(row, np.arange(1, hi - lo))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([c.tolist() for c in np.split(col, cut)], pa.list_(pa.int64())), pa.array([c.tolist() for c in np.split(val, cut)], pa.list_(pa.float64())), pa.array(words.astype(np.int64))], ["y", "cols", "vals", "words"])

    sample = rows.mapInArrow(rows_of, "y int, cols array<long>, vals array<double>, words long").collect()
    sample.sort(key=lambda r: (r["y"], r["words"], r["cols"], r["vals"]))
    row = np.repeat(np.arange(len(sample)), [len(r["cols"]) for r in sample])
    col, val = (np.concatenate([np.zeros(0), *(r[c] for r in sample)]) for c in ("cols", "vals"))
    x = (row, col.astype(np.int64), val, len(kept))
    y = np.array([r["y"] for r in sample])
    share = np.bincount(row, np.expm1(val), len(y)) / np.maximum([r["words"] for r in sample], 1)
    cuts = np.quantile(share[y == 1], [1 / 3, 2 / 3])
    grade = np.where(y == 1, 1 + np.searchsorted(cuts, share, "left"), 0)
    weight = np.where(y == 1, 0.5 / max((y == 1).mean(), 1e-9), 0.5 / max((y == 0).mean(), 1e-9))
    w, theta = fit_ordinal(x, grade, weight)
    model = OrdinalModel(kept, w, theta)
    model.cut = best_cut(model.above(np.bincount(row, w[x[1]] * val, len(y)))[:, 0], y, n[1] / (n[0] + n[1]))
    # a text without features is not toxic
    model.cut = max(model.cut, float(np.nextafter(model.above(np.zeros(1))[0, 0], 2)))
    return model


def best_cut(p: np.ndarray, y: np.ndarray, prior: float) -> float:
    """The chance of toxicity from which a document counts as toxic: best F1 with the classes at their true shares."""
    steps = np.unique(np.quantile(p, np.linspace(0, 1, 400)))
    cuts = (steps[1:] + steps[:-1]) / 2 if len(steps) > 1 else steps
    hit = np.array([(p[y == 1] >= c).mean() for c in cuts]) * prior
    false = np.array([(p[y == 0] >= c).mean() for c in cuts]) * (1 - prior)
    return float(cuts[np.argmax(2 * hit / (prior + hit + false))])


def _scorer(model: OrdinalModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                s, p = model.severity(b.column(1).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(s), pa.array(p)], ["key", "severity", "p_toxic"])

    return score


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, severity, p_toxic, toxic) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(_scorer(model), f"key {kind}, severity double, p_toxic double")
    return out.withColumnRenamed("key", id_col).withColumn("toxic", (F.col("p_toxic") >= model.cut).cast("int"))
