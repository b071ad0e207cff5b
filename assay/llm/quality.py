"""Quality by a linear-chain conditional random field over lines.

Every line of the whole text is good or bad; a line's features are shares and shapes of its characters and words, with
those of its neighbours. Forward and backward passes give each line's chance of being good; weighted by line length they
make the document's raw quality, which a logistic curve turns into the chance of label 1.

Trained on document labels (a line has its document's label) over a bounded sample: at most ``per_class``
documents a class, picked by a hash of their id. Defined results: a null or empty text is one empty line. Labels that
contradict each other for one id count by their smallest value. Without labelled documents of both classes (empty tables
among them) nothing tells documents apart and each score is 0.5. Other columns of the tables are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.features import bounded_sample, free_names
from assay.llm.hashing import _LOWER, chunks, range_hash, string_bytes, word_spans

PER_CLASS = 1200
# Bin edges of the line features, in this order.
EDGES = {
    "bytes": (1, 20, 60, 120, 300, 800),
    "words": (1, 2, 5, 12, 40, 120),
    "upper": (0.001, 0.02, 0.06, 0.15, 0.4, 0.7),
    "digit": (0.001, 0.01, 0.05, 0.2),
    "bang": (0.001, 0.01, 0.05),
    "pipe": (0.001, 0.01, 0.05),
    "mark": (0.001, 0.01, 0.05, 0.15),
    "stop": (0.001, 0.01, 0.02, 0.05),
    "other": (0.001, 0.01, 0.05),
    "high": (0.001, 0.02, 0.06, 0.12),
    "distinct": (0.2, 0.4, 0.6, 0.8, 0.95, 0.999),
    "runs": (0.001, 0.05, 0.2, 0.5),
    "length": (2.0, 3.5, 5.0, 7.0, 10.0, 20.0),
}
NAMES = list(EDGES)
WIDTH = sum(len(e) + 1 for e in EDGES.values())
N_FEATURES = 3 * WIDTH + 3


def line_shapes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row of numbers a line (columns as NAMES), the lines' bytes, and n + 1 offsets of the texts into the lines."""
    raw, offs = string_bytes(arr)
    n = len(offs) - 1
    nl = np.flatnonzero(raw == 10)
    owner_nl = np.searchsorted(offs, nl, "right") - 1
    starts = np.sort(np.concatenate([offs[:-1], nl + 1]), kind="stable")
    at = np.concatenate([[0], np.cumsum(np.bincount(owner_nl, minlength=n) + 1)])
    text_end = np.repeat(offs[1:], np.diff(at))
    ends = np.minimum(np.concatenate([starts[1:], offs[-1:]]), text_end)
    last = np.zeros(len(starts), bool)
    last[at[1:] - 1] = True
    ends = np.where(last, text_end, ends - 1)
    size = ends - starts

    def share(mask: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(mask)])
        return (run[ends] - run[starts]) / np.maximum(size, 1)

    low = _LOWER[raw]
    letter, digit, high = (low >= 97) & (low <= 122), (raw >= 48) & (raw <= 57), raw >= 128
    s, e, _ = word_spans(raw, offs)
    line_of = np.searchsorted(starts, s, "right") - 1
    n_words = np.bincount(line_of, minlength=len(starts))
    h = range_hash(low, s, e) if len(s) else np.zeros(0, np.uint64)
    order = np.lexsort((h, line_of))
    ho, lo = h[order], line_of[order]
    fresh = np.ones(len(ho), bool)
    fresh[1:] = (ho[1:] != ho[:-1]) | (lo[1:] != lo[:-1])
    distinct = np.bincount(lo[fresh], minlength=len(starts))
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    chars = np.bincount(line_of, weights=e - s, minlength=len(starts))
    columns = {
        "bytes": size,
        "words": n_words,
        "upper": share((raw >= 65) & (raw <= 90)),
        "digit": share(digit),
        "bang": share((raw == 33) | (raw == 63)),
        "pipe": share(raw == 124),
        "mark": share(np.isin(raw, np.frombuffer(b"*%$&#@~^_=+<>{}[]\\/;", np.uint8))),
        "stop": share(np.isin(raw, np.frombuffer(b".,", np.uint8))),
        "other": share(~(letter | digit | high) & (raw > 32)),
        "high": share(high),
        "distinct": np.where(n_words > 1, distinct / np.maximum(n_words, 1), 1.0),
        "runs": np.bincount(line_of, weights=again, minlength=len(starts)) / np.maximum(n_words, 1),
        "length": chars / np.maximum(n_words, 1),
    }
    return np.stack([columns[k] for k in NAMES], axis=1), size, at


def line_features(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the active features of each line (its own bins, its neighbours' bins, place), bytes, offsets."""
    shape, size, at = line_shapes(arr)
    base, cols = 0, []
    for k, name in enumerate(NAMES):
        cols.append(base + np.searchsorted(EDGES[name], shape[:, k], "right"))
        base += len(EDGES[name]) + 1
    own = np.stack(cols, axis=1)
    first, last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    first[at[:-1]], last[at[1:] - 1] = True, True
    # a line without a neighbour on a side has the place feature instead, N_FEATURES standing for "none"
    before = np.where(first[:, None], N_FEATURES, np.roll(own, 1, axis=0) + WIDTH)
    after = np.where(last[:, None], N_FEATURES, np.roll(own, -1, axis=0) + 2 * WIDTH)
    place = np.stack([np.full(len(own), 3 * WIDTH), np.where(first, 3 * WIDTH + 1, N_FEATURES), np.where(last, 3 * WIDTH + 2, N_FEATURES)], axis=1)
    return np.concatenate([own, before, after, place], axis=1), size, at


def marginals(unary: np.ndarray, at: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line and the expected transitions of each text; all texts step together, longest first.

    ``unary`` is the score of good over bad. The passes keep one normalised pair of numbers a text and line.
    """
    n_lines = np.diff(at)
    order = np.argsort(-n_lines, kind="stable")
    start, count = at[:-1][order], n_lines[order]
    longest = int(count.max(initial=0))
    alive = [int(np.searchsorted(-count, -t, "left")) for t in range(longest)]  # texts with more than t lines
    u = np.clip(unary, -30, 30)
    emit = np.stack([np.ones_like(u), np.exp(u)], axis=1)
    a = np.exp(trans)
    fwd, bwd = np.empty_like(emit), np.empty_like(emit)
    for t in range(longest):
        i = start[: alive[t]] + t
        x = emit[i] if t == 0 else (fwd[i - 1] @ a) * emit[i]
        fwd[i] = x / x.sum(axis=1, keepdims=True)
    for t in range(longest - 1, -1, -1):
        i = start[: alive[t]] + t
        x = np.ones((alive[t], 2))
        if t + 1 < longest:
            k = alive[t + 1]
            x[:k] = (emit[i[:k] + 1] * bwd[i[:k] + 1]) @ a.T
        bwd[i] = x / x.sum(axis=1, keepdims=True)
    p = fwd * bwd
    p /= p.sum(axis=1, keepdims=True)
    inner = np.ones(len(u), bool)
    inner[at[1:] - 1] = False
    i = np.flatnonzero(inner)
    pair = fwd[i][:, :, None] * a[None] * (emit[i + 1] * bwd[i + 1])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return p[:, 1], pair


class LineCrf:
    def __init__(self, w: np.ndarray, trans: np.ndarray, slope: float = 1.0, shift: float = 0.0):
        self.w, self.trans, self.slope, self.shift = w, trans, slope, shift

    def raw(self, feats: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
        p, _ = marginals(self.w[feats].sum(axis=1), at, self.trans)
        weight = np.maximum(size, 1).astype(float)
        return np.add.reduceat(p * weight, at[:-1]) / np.add.reduceat(weight, at[:-1])

    def score(self, arr: pa.Array) -> np.ndarray:
        if not len(arr):
            return np.zeros(0)
        return self.calibrated(self.raw(*line_features(arr)))

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit(raw) + self.shift, -500, 500)))


#: The model without labels: 0.5 for every text.
UNKNOWN = LineCrf(np.zeros(N_FEATURES + 1), np.zeros((2, 2)), 0.0, 0.0)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_crf(feats: np.ndarray, size: np.ndarray, at: np.ndarray, y: np.ndarray, prior: float, steps: int = 150, l2: float = 1e-3) -> LineCrf:
    """Weights by full-batch Adam on the texts' mean log-likelihood per line, classes weighed alike; then the curve."""
    n_lines = np.diff(at)
    line_y = np.repeat(y, n_lines).astype(float)
    doc_w = np.where(y == 1, 0.5 / max((y == 1).mean(), 1e-9), 0.5 / max((y == 0).mean(), 1e-9)) / n_lines
    line_w = np.repeat(doc_w, n_lines)
    inner = np.ones(len(line_y), bool)
    inner[at[1:] - 1] = False
    i = np.flatnonzero(inner)
    k = line_y[i].astype(int)
    par = np.zeros(N_FEATURES + 4)
    m, v = np.zeros_like(par), np.zeros_like(par)
    flat = feats.ravel()
    for step in range(1, steps + 1):
        w = np.append(par[:N_FEATURES], 0.0)
        trans = par[N_FEATURES:].reshape(2, 2)
        p, pair = marginals(w[feats].sum(axis=1), at, trans)
        gw = np.bincount(flat, weights=np.repeat(line_w * (p - line_y), feats.shape[1]), minlength=N_FEATURES + 1)[:N_FEATURES]
        seen = np.zeros((len(i), 2, 2))
        seen[np.arange(len(i)), k, k] = 1
        gt = ((pair - seen) * line_w[i][:, None, None]).sum(axis=0).ravel()
        g = np.concatenate([gw, gt]) / len(y) + np.concatenate([l2 * par[:N_FEATURES], 0.02 * par[N_FEATURES:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par -= 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    crf = LineCrf(np.append(par[:N_FEATURES], 0.0), par[N_FEATURES:].reshape(2, 2))
    # logistic curve with the classes at their true shares
    x = logit(crf.raw(feats, size, at))
    wt = np.where(y == 1, prior / max((y == 1).mean(), 1e-9), (1 - prior) / max((y == 0).mean(), 1e-9))
    b = np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(b[0] * x + b[1], -30, 30)))
        grad = np.array([(wt * (q - y) * x).sum(), (wt * (q - y)).sum()]) + [1e-2 * b[0], 0]
        h = wt * q * (1 - q) + 1e-9
        hess = np.array([[(h * x * x).sum() + 1e-2, (h * x).sum()], [(h * x).sum(), h.sum()]])
        b = b - np.linalg.solve(hess, grad)
    return LineCrf(crf.w, crf.trans, float(max(b[0], 1e-3)), float(b[1]))


def _featurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in chunks(b.column(1)):
            f, size, at = line_features(b.column(1).slice(lo, hi - lo))
            f = f.astype("<i2")
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([f[x:y].tobytes() for x, y in zip(at, at[1:], strict=False)], pa.binary()), pa.array([size[x:y].astype("<i4").tobytes() for x, y in zip(at, at[1:], strict=False)], pa.binary())], ["y", "f", "size"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> LineCrf:
    """A model from at most ``per_class`` documents of either class among the labels that ``learn`` admits."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if learn is not None:
        known = known.where(learn)
    known = known.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).groupBy("_id").agg(F.min((F.col("_label") > 0).cast("int")).alias("y"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return UNKNOWN
    chosen = F.broadcast(bounded_sample(known, "_id", per_class, "y"))  # bounded: per_class ids of either class
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    rows = texts.join(chosen, F.col("_doc") == F.col("_id")).select("y", "text").mapInArrow(_featurer, "y int, f binary, size binary").collect()
    if len({r["y"] for r in rows}) < 2:
        return UNKNOWN
    rows.sort(key=lambda r: (r["y"], bytes(r["size"]), bytes(r["f"])))
    size = np.concatenate([np.frombuffer(r["size"], "<i4") for r in rows])
    feats = np.concatenate([np.frombuffer(r["f"], "<i2") for r in rows]).reshape(len(size), -1).astype(np.int64)
    at = np.concatenate([[0], np.cumsum([len(r["size"]) // 4 for r in rows])])
    return fit_crf(feats, size, at, np.array([r["y"] for r in rows]), n[1] / (n[0] + n[1]))


def _scorer(model: LineCrf, names: list[str], into: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.num_columns - 1)
            for lo, hi in chunks(text):
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(b.num_columns - 1)), pa.array(model.score(part.column(b.num_columns - 1)))], [*names, into])

    return score


def score(docs: DataFrame, model: LineCrf, keep: list[str], text_col: str = "text", into: str = "_score") -> DataFrame:
    """The columns ``keep`` of every row and its score in ``into``; only the text is looked at."""
    text = free_names(docs, "_text")[0]
    rows = docs.select(*keep, F.col(text_col).alias(text))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text) + f", {into} double"
    return rows.mapInArrow(_scorer(model, keep, into), ddl)
