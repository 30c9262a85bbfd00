"""Quality classifier by positive-unlabelled learning.

Trusted positives P and unlabelled text U (a mixture with an unknown share pi of positives) are all
the learner sees; labels of negatives are never read. A linear model g minimises the non-negative
unbiased risk

    pi E_P[l(g)] + max(0, E_U[l(-g)] - pi E_P[l(-g)])

with the logistic loss: when the second part falls below zero, the step undoes it instead of
driving it further down. The prior comes from a first model q of "from P or from U": p_P / p_U is at
most 1 / pi, and reaches it where only positives live, so pi is one over the top of that ratio (its
90 % quantile, against noise) at positives left out of q. Too large a prior would stop the descent
before the negatives in U are told apart; too small a one only lowers the scores of positives to it.

The descent reads a bounded sample (``max_positive`` and ``max_unlabelled`` rows, those with the
smallest hash of the id; of an id that repeats, the smallest text); the means and deviations that scale
the measures come from all training texts, and every document is scored, over its whole text.

Cases: null and empty texts get the score of an empty text; null or repeated ids each get a row;
labels whose documents are missing are ignored; without any positives every score is the prior
guess 0.5; an empty table gives no rows; other columns are never features.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from .common import batches, free_memory
from .quality_rules import measure_text

BINS = 1 << 12
_KIND = np.zeros(256, np.int64)  # 0 other, 1 digit, 2 ASCII punctuation, 3 beyond ASCII
_KIND[48:58] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
_KIND[128:] = 3
N_DENSE = 12


def features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dense measures, hashed word bins, their shares) of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    n, chars, symbols, dup, repeat, lines, caps = measure_text(raw)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=4)
    words = raw.lower().split()
    d, w, c = max(len(raw), 1), max(n, 1), max(chars, 1)
    bins, count = np.unique(np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n) % np.uint64(BINS), return_counts=True)
    dense = np.array([np.log1p(n), np.log1p(chars / w), np.sqrt(symbols / w), dup / max(lines, 1), repeat / w, caps / c,
                      np.sqrt(kinds[1] / d), np.sqrt(kinds[2] / d), kinds[3] / d, len(set(words)) / w, np.sqrt(lines / w),
                      float(repeat > 0.5 * w)])
    return dense, bins.astype(np.int64), count / w


class Rows:
    """Feature rows as one dense block and one list of (row, bin, share)."""

    def __init__(self, texts: list[str]):
        parts = []  # each text's small arrays give way to a block's: thousands of them would break up the heap
        for lo in range(0, len(texts), 256):
            got = [features(t) for t in texts[lo:lo + 256]]
            parts.append((np.array([g[0] for g in got]), np.array([len(g[1]) for g in got]),
                          np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got])))
        dense, each, bins, share = zip(*parts, strict=True) if parts else [()] * 4
        self.n = len(texts)
        self.dense = np.concatenate([np.zeros((0, N_DENSE)), *dense])
        self.row = np.repeat(np.arange(self.n), np.concatenate([np.zeros(0, np.int64), *each]))
        self.bin = np.concatenate([np.zeros(0, np.int64), *bins])
        self.share = np.concatenate([np.zeros(0), *share])

    def take(self, keep: np.ndarray) -> "Rows":
        out = object.__new__(Rows)
        new = np.cumsum(keep) - 1
        on = keep[self.row]
        out.n, out.dense = int(keep.sum()), self.dense[keep]
        out.row, out.bin, out.share = new[self.row[on]], self.bin[on], self.share[on]
        return out


class Model:
    """Linear scores on standardised measures and word shares."""

    def __init__(self, mean: np.ndarray, std: np.ndarray):
        self.mean, self.std = mean, std
        self.w = np.zeros(N_DENSE + BINS + 1)

    def _z(self, r: Rows) -> np.ndarray:
        return np.clip((r.dense - self.mean) / self.std, -6, 6)

    def margin(self, r: Rows) -> np.ndarray:
        of_words = self.w[N_DENSE:-1][r.bin]
        of_words *= r.share
        words = np.bincount(r.row, of_words, minlength=r.n)
        return self._z(r) @ self.w[:N_DENSE] + words + self.w[-1]

    def gradient(self, r: Rows, slope: np.ndarray) -> np.ndarray:
        """Sum of slope times the features, over rows."""
        of_rows = slope[r.row]
        of_rows *= r.share
        return np.concatenate([slope @ self._z(r), np.bincount(r.bin, of_rows, minlength=BINS), [slope.sum()]])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _descend(model: Model, step_of, steps: int, rate: float, decay: float) -> None:
    """Adam on the full sample."""
    m, v = np.zeros_like(model.w), np.zeros_like(model.w)
    for t in range(1, steps + 1):
        g = step_of()
        g[:-1] += decay * model.w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        model.w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)


def estimate_prior(pos: Rows, unl: Rows, mean, std, steps: int = 80) -> float:
    """Share of positives in the unlabelled rows (see the module's text)."""
    fit = np.arange(pos.n) % 2 == 0
    a, b = pos.take(fit), pos.take(~fit)
    q = Model(mean, std)

    def step():
        sa, su = _sigmoid(q.margin(a)), _sigmoid(q.margin(unl))
        return q.gradient(a, (sa - 1) / a.n) / 2 + q.gradient(unl, su / unl.n) / 2
    _descend(q, step, steps, 0.05, 1e-3)
    ratio = np.exp(np.clip(q.margin(b if b.n else a), -10, 10))  # equal weights: odds are p_P / p_U
    return float(np.clip(1 / np.quantile(ratio, 0.9), 0.05, 0.95))


def moments(docs: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and deviation of the dense measures over all texts of ``docs`` (column text): sums of each
    batch, added up."""
    def run(it):
        for b in it:
            x = np.array([features(t)[0] for t in batches(b.column(0))]).reshape(-1, N_DENSE)
            v = np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v)), pa.int64()), pa.array(v)], names=["i", "v"])
        free_memory()
    got = docs.select("text").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").toPandas()["v"].to_numpy()
    if not len(got) or not got[0]:
        return None
    mean = got[1:1 + N_DENSE] / got[0]
    return mean, np.sqrt(np.maximum(got[1 + N_DENSE:] / got[0] - mean * mean, 0)) + 1e-6


def risk(model: "Model", pos: Rows, unl: Rows, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative unbiased risk, and the direction of descent: its gradient, or, where the part
    that belongs to negatives falls below zero, the gradient that undoes this."""
    gp, gu = model.margin(pos), model.margin(unl)
    negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
    plus = model.gradient(pos, prior * (_sigmoid(gp) - 1) / pos.n)
    minus = model.gradient(unl, _sigmoid(gu) / unl.n) - model.gradient(pos, prior * _sigmoid(gp) / pos.n)
    return prior * np.logaddexp(0, -gp).mean() + max(0.0, negative), plus + minus if negative >= 0 else -minus


def fit(pos: Rows, unl: Rows, prior: float | None = None, steps: int = 200, rate: float = 0.05,
        decay: float = 1e-4, scale: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[Model, float]:
    """Model of least non-negative unbiased risk, and the prior it used. ``scale`` gives the mean and
    deviation of the dense measures (those of ``unl`` if not given)."""
    mean, std = scale or (unl.dense.mean(0), unl.dense.std(0) + 1e-6)
    prior = estimate_prior(pos, unl, mean, std) if prior is None else prior
    model = Model(mean, std)

    _descend(model, lambda: risk(model, pos, unl, prior)[1], steps, rate, decay)
    return model, prior


def sample_texts(docs: DataFrame, ids: DataFrame | None, limit: int) -> list[str]:
    """At most ``limit`` texts, by the smallest hash of the id; of the given ids, or of all. Ids
    are chosen before any text is read."""
    pool = docs.select("doc_id") if ids is None else ids.select("doc_id")
    chosen = pool.where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(limit)
    one = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))  # at most ``limit`` ids, a text for each
    rows = one.toPandas()
    return ["" if t is None else t for t in rows.sort_values("doc_id", kind="stable")["text"]]


def train(docs: DataFrame, positives: DataFrame, max_positive: int = 3000, max_unlabelled: int = 6000) -> tuple[Model | None, float]:
    """Fit on (doc_id, text) and the ids of trusted positives. The driver holds the texts of one sample
    at a time, only until they are measured, and keeps none of this memory for the jobs to come."""
    p = Rows(sample_texts(docs, positives, max_positive))
    free_memory()
    u = Rows(sample_texts(docs, None, max_unlabelled))
    free_memory()
    try:
        return fit(p, u, scale=moments(docs)) if p.n and u.n else (None, 0.5)
    finally:
        del p, u
        free_memory()


def with_score(docs: DataFrame, model: Model | None, text_col: str = "text", out: str = "pu_score") -> DataFrame:
    """``docs`` with all its columns and a score column (replaced if there); the model (34 KB)
    travels with the tasks."""
    docs = docs.drop(out)

    def run(it):
        for b in it:
            texts = batches(b.column(text_col))
            parts = [np.zeros(0)]
            for lo in range(0, len(texts), 256):
                r = Rows(texts[lo:lo + 256])
                parts.append(np.full(r.n, 0.5) if model is None else _sigmoid(model.margin(r)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(parts))], names=[*b.schema.names, out])
        free_memory()
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_score(src, model).select("doc_id", F.col("pu_score").alias("score"))


def learn(docs: DataFrame, labels: DataFrame, held_out, max_positive: int = 3000, max_unlabelled: int = 6000,
          id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Fit on the rows of ``docs`` and the positives of ``labels`` (doc_id, quality) for which
    ``held_out`` (a function from an id column's name to a boolean column) is false."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return train(src.where(~held_out("doc_id")), labels.where("quality = 1").where(~held_out("doc_id")), max_positive, max_unlabelled)[0]
