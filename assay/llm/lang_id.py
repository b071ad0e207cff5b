"""Language identification in two levels: the family first, then linear one-against-one machines inside it.

Features are hashed byte n-grams of the whole text, as shares. One linear machine a family (one against the rest) picks
the family; within it every pair of languages has a linear support vector machine, and the language with most votes
wins, the summed margin deciding ties. All machines are fitted by averaged subgradient steps on the hinge loss over a
bounded sample: at most ``per_lang`` labelled documents a language, picked by a hash of their id.

Defined results: ``und`` with score 0 for a null text and one without a letter. With one learnt language that one is
given. Languages that the family table lacks are families of their own. Without a labelled document (empty tables among
them) every text is ``und`` with score 0. The score is the product of two logistic curves, of the family's lead over the
next one and of the summed margins inside it. Other columns of the tables are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.features import bounded_sample, free_names, ngram_ids
from assay.llm.hashing import chunks

SIZES = (1, 2, 3, 4)
DIMS = 1 << 13
PER_LANG = 600
# Families of common languages.
FAMILIES = {
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "be"),
}


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def shares(arr: pa.Array, dims: int = DIMS) -> np.ndarray:
    """Scaled n-gram shares of each text (rows x dims); empty texts are zero."""
    ids, rows, n_bytes = ngram_ids(arr, SIZES, dims)
    out = np.bincount(rows * dims + ids, minlength=len(n_bytes) * dims).reshape(len(n_bytes), dims).astype(np.float32)
    return scale(out, n_bytes)


def scale(counts: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    return counts / np.maximum(n_bytes, 1)[:, None].astype(np.float32)


def fit_machine(x: np.ndarray, y: np.ndarray, epochs: int = 12, decay: float = 1e-3, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine on the hinge loss, classes weighed alike; y is +1 or -1."""
    rng = np.random.default_rng(seed)
    size = np.sqrt((x * x).sum(axis=1).mean()) or 1.0
    z = np.concatenate([x / size, np.ones((len(x), 1), np.float32)], axis=1)
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    w, total, step = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 0
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        for lo in range(0, len(z), 32):
            b = order[lo : lo + 32]
            step += 1
            bad = y[b] * (z[b] @ w) < 1
            w *= 1 - min(0.5, 1.0 / (step + 10))
            w += (z[b] * (y[b] * weight[b] * bad)[:, None]).sum(axis=0) / (len(b) * decay * (step + 10))
            if epoch >= epochs // 2:
                total += w
    return (total[:-1] / size).astype(np.float32), float(total[-1])


class LangModel:
    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(v) for v in self.langs})
        lang, fam = np.array(langs), np.array([family_of(v) for v in langs])
        self.pairs = [(a, b) for f in self.families for a, b in combinations([v for v in self.langs if family_of(v) == f], 2)]
        cols, bias, span = [], [], []
        wanted = [(fam == f, np.ones(len(x), bool)) for f in self.families] + [(lang == a, (lang == a) | (lang == b)) for a, b in self.pairs]
        for yes, use in wanted:
            w, b0 = fit_machine(x[use], np.where(yes[use], 1.0, -1.0)) if yes[use].any() and (~yes[use]).any() else (np.zeros(x.shape[1], np.float32), 1.0)
            m = np.abs(x[use] @ w + b0)
            cols.append(w)
            bias.append(b0)
            span.append(float(np.median(m)) or 1.0)
        span_ = np.array(span)
        self.w = (np.stack(cols, axis=1) / span_).astype(np.float32) if cols else np.zeros((x.shape[1], 0), np.float32)
        self.b = np.array(bias) / span_

    def margins(self, arr: pa.Array) -> np.ndarray:
        """Margins of all machines, from the n-grams alone: no dense row of features is built."""
        ids, rows, n_bytes = ngram_ids(arr, SIZES, len(self.w))
        n = len(n_bytes)
        out = np.stack([np.bincount(rows, weights=self.w[ids, c], minlength=n) for c in range(self.w.shape[1])], axis=1) if self.w.shape[1] else np.zeros((n, 0))
        return out / np.maximum(n_bytes, 1)[:, None] + self.b

    def predict(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        m = self.margins(arr)
        nf = len(self.families)
        fam = m[:, :nf].argmax(axis=1)
        top = np.sort(m[:, :nf], axis=1)
        sure = 1 / (1 + np.exp(-2 * (top[:, -1] - top[:, -2]))) if nf > 1 else np.ones(len(m))
        pred, score = np.empty(len(m), object), np.zeros(len(m))
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(fam == k)
            members = [v for v in self.langs if family_of(v) == f]
            votes, summed = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for c, (a, b) in enumerate(self.pairs):
                if family_of(a) == f:
                    x = m[rows, nf + c]
                    i, j = members.index(a), members.index(b)
                    votes[np.arange(len(rows)), np.where(x >= 0, i, j)] += 1
                    summed[:, i] += x
                    summed[:, j] -= x
            best = (votes + 1e-3 * np.tanh(summed)).argmax(axis=1)
            pred[rows] = np.array(members, object)[best]
            score[rows] = sure[rows] * (1 / (1 + np.exp(-2 * summed[np.arange(len(rows)), best])) if len(members) > 1 else 1)
        return pred, np.clip(score, 0, 1)


def _featurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 64):
            part = b.slice(lo, 64)
            x = shares(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([v.astype("<f4").tobytes() for v in x], pa.binary())], ["lang", "x"])


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> LangModel | None:
    """A model from at most ``per_lang`` documents of each non-null language among those that ``learn`` admits."""
    known = docs.where(learn).select(F.col(id_col).alias("_doc"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    chosen = bounded_sample(known.select(F.col("_doc").alias("_id"), F.col("lang").alias("_lang")), "_id", per_lang, "_lang")
    # bounded: per_lang ids for each language
    text = known.join(F.broadcast(chosen.select("_id", "_lang")), (F.col("_doc") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    rows = text.select("lang", "text").mapInArrow(_featurer, "lang string, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    return LangModel(np.stack([np.frombuffer(r["x"], "<f4") for r in rows]), [r["lang"] for r in rows])


def _predictor(model: LangModel, column: str):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.schema.get_field_index(column))
            for lo, hi in chunks(text):
                pred, score = model.predict(text.slice(lo, hi - lo))
                part = b.slice(lo, hi - lo)
                keep = [c for c in part.schema.names if c != column]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(list(pred), pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    return predict


def predict(docs: DataFrame, model: LangModel | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with lang_pred and score; only the text is looked at."""
    if model is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    text, letters = free_names(docs, "_text", "_letters")
    rows = docs.select(*keep, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(letters), F.col(text_col).alias(text))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text) + ", lang_pred string, score double"
    out = rows.mapInArrow(_predictor(model, text), ddl)
    return out.select(*keep, F.when(F.col(letters), F.col("lang_pred")).otherwise("und").alias("lang_pred"), F.when(F.col(letters), F.col("score")).otherwise(0.0).alias("score"))
