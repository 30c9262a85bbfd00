"""Periodic runs of words: seed-and-extend along the diagonals of a document.

A run is a stretch of words that repeats with smallest period q, is at least ``max(12, 2 q)`` words
long and cannot be made longer with that period. Words q apart agree in all of it, so its diagonal
(the pairs of words q apart) holds at least ``max(12 - q, q)`` matches in a row. That is the
guaranteed overlap: lags below 12 are seeded by 6-grams, lags from 12 to 23 by 12-grams, from 24 to
47 by 24-grams and so on. Each band of lags indexes the k-grams of its overlap within each document,
enumerates the pairs of occurrences whose distance lies in the band, and extends each pair both ways
along its diagonal. A table with one entry for each lag, the furthest word covered so far, drops
seeds that an extension has already passed.

Pairs stay few: k-grams without a short period recur at most twice in a band. A k-gram with a
period of at most k / 2 lies inside one run that an earlier band has found; there only the first
k-gram of such a run, on either side of the pair, can seed a run that is new, so the others are left
out. Every level of k-grams is ranked from pairs of the level before, exactly and without hashing,
and holds only k-grams that recur in their document.

Cases: a null or empty text has no words and no runs; texts are read whole, however long; repeated
rows and ids each get a row; a null id gets its row; an empty table gives none; other columns are
ignored. Of stretches with several periods only the smallest counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_memory

SEED = 6            # overlap of any run with a period below 2 * SEED
BATCH_WORDS = 1 << 17  # words of several texts that are searched at once; a longer text alone

RUNS = "array<struct<start:long,length:long,period:long>>"


def _recurring(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
    """Ranks of the grams made of ``a`` and, ``gap`` words on, ``b``; -1 where a gram occurs once."""
    out = np.full(len(a), -1, np.int64)
    n = len(a) - gap
    if n <= 0:
        return out
    at = np.flatnonzero((a[:n] >= 0) & (b[gap:] >= 0))
    if not len(at):
        return out
    key = a[at] * (int(b.max()) + 1) + b[at + gap]
    order = np.argsort(key, kind="stable")
    s = key[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    group = np.cumsum(first) - 1
    many = np.bincount(group) > 1
    rank = np.cumsum(many) - 1
    keep = many[group]
    out[at[order[keep]]] = rank[group[keep]]
    return out


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) for every index from lo to hi - 1 of each row."""
    size = np.maximum(hi - lo, 0)
    row = np.repeat(np.arange(len(lo)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size - lo, size)


class _Index:
    """Occurrences of the recurring k-grams, found by gram and position."""

    def __init__(self, gram: np.ndarray):
        self.gram, self.n = gram, len(gram)
        self.step = self.n + 1
        at = np.flatnonzero(gram >= 0)
        self.at = at[np.argsort(gram[at], kind="stable")]
        self.key = gram[self.at] * self.step + self.at

    def partners(self, seeds: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (seed, occurrence of its gram low to high words further on; negative: before it)."""
        base = self.gram[seeds] * self.step
        lo = np.searchsorted(self.key, base + np.clip(seeds + low, 0, self.n))
        hi = np.searchsorted(self.key, base + np.clip(seeds + high, -1, self.n), side="right")
        row, k = _expand(lo, hi)
        return seeds[row], self.at[k]


def _matches(w: np.ndarray, i: int, j: int) -> int:
    """How many words from i and from j (j > i) on agree."""
    done, size = 0, 32
    while j + done < len(w):
        m = min(size, len(w) - j - done)
        differ = np.flatnonzero(w[i + done:i + done + m] != w[j + done:j + done + m])
        if len(differ):
            return done + int(differ[0])
        done += m
        size = min(size * 4, 1 << 16)
    return done


def _matches_before(w: np.ndarray, i: int, j: int) -> int:
    """How many words before i and before j (j > i) agree."""
    done, size = 0, 32
    while i - done > 0:
        m = min(size, i - done)
        differ = np.flatnonzero(w[i - done - m:i - done] != w[j - done - m:j - done])
        if len(differ):
            return done + m - 1 - int(differ[-1])
        done += m
        size = min(size * 4, 1 << 16)
    return done


def _diagonals(w: np.ndarray, lag: np.ndarray, at: np.ndarray, k: int):
    """(lag, start, matches) of the diagonals through the seeds (words from ``at`` on agree, for k
    words, with those ``lag`` further on)."""
    order = np.lexsort((at, lag))
    lag, at = lag[order], at[order]
    head = np.concatenate([[True], (lag[1:] != lag[:-1]) | (at[1:] > at[:-1] + 1)])  # seeds side by side are one
    covered: dict[int, int] = {}  # lag -> first word that no extension has reached
    for q, i in zip(lag[head].tolist(), at[head].tolist(), strict=True):
        if i < covered.get(q, 0):
            continue
        start = i - _matches_before(w, i, i + q)
        end = i + k + _matches(w, i + k, i + q + k)
        covered[q] = end
        yield q, start, end - start


def _inside(runs: np.ndarray, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each k-gram the run (a row of ``runs``: start, end, period) with a period of at most k / 2
    that it lies in, or -1; and the first k-grams of those runs."""
    owner = np.full(n, -1, np.int64)
    if not len(runs):
        return owner, np.zeros(0, np.int64)
    r = np.flatnonzero((2 * runs[:, 2] <= k) & (runs[:, 1] - runs[:, 0] >= k))
    row, i = _expand(runs[r, 0], runs[r, 1] - k + 1)
    owner[i] = r[row]
    return owner, runs[r, 0]


def runs_of(w: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the runs of ``w``, sorted by start and period. Equal values are
    equal words; several documents may stand one after another if they share no value."""
    n = len(w)
    one = np.where(np.bincount(w)[w] > 1, w, -1) if n else w
    two = _recurring(one, one, 1)
    three = _recurring(two, one, 2)
    gram = _recurring(three, three, 3)
    found: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period

    def add(diagonals):
        for q, start, m in diagonals:
            if m >= max(2 * SEED - q, q):
                found.setdefault((start, start + m + q), q)  # lags come in ascending order

    low, k = 1, SEED
    while (gram >= 0).any():
        index = _Index(gram)
        seeds = np.flatnonzero(gram >= 0)
        high = 2 * k - 1
        if low == 1:
            i, j = index.partners(seeds, low, high)
        else:
            known = np.array([(s, e, q) for (s, e), q in found.items()], np.int64).reshape(-1, 3)
            owner, firsts = _inside(known, k, n)
            first = np.zeros(n, bool)
            first[firsts] = True
            i, j = index.partners(seeds[(owner[seeds] < 0) | first[seeds]], low, high)
            back, front = index.partners(seeds[first[seeds]], -high, -low)
            i, j = np.concatenate([i, front]), np.concatenate([j, back])
            new = (owner[i] < 0) | (owner[i] != owner[j])
            i, j = i[new], j[new]
        if len(i):
            add(_diagonals(w, j - i, i, k))
        gram = _recurring(gram, gram, k)
        low, k = 2 * k, 2 * k
    out = np.array([(s, e, q) for (s, e), q in found.items()], np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _search(texts: list[list[bytes]]):
    """(runs, collapsed text) of each list of words; all lists are searched as one sequence."""
    code: dict[bytes, int] = {}
    parts, base = [], 0
    for words in texts:
        code.clear()
        parts.append(np.fromiter((code.setdefault(x, len(code)) for x in words), np.int64, len(words)) + base)
        base += len(code)  # no value is shared between documents
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    runs = runs_of(np.concatenate(parts)) if parts else np.zeros((0, 3), np.int64)
    cut = np.searchsorted(runs[:, 0], at)
    for d, words in enumerate(texts):
        mine = runs[cut[d]:cut[d + 1]] - np.array([at[d], at[d], 0])
        if not len(mine):
            yield mine, b" ".join(words)
            continue
        keep = np.ones(len(words), bool)
        for s, e, q in mine.tolist():
            keep[s + q:e] = False
        yield mine, b" ".join([words[x] for x in np.flatnonzero(keep).tolist()])


def _run(it):
    def pack(ids, texts):
        spans, collapsed = [], []
        for runs, text in _search(texts):
            spans.append(runs)
            collapsed.append(text)
        rows = np.concatenate([np.zeros((0, 3), np.int64), *spans])
        ends = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32)
        item = pa.StructArray.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1] - rows[:, 0]), pa.array(rows[:, 2])],
                                          names=["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), item),
             pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    for b in it:
        ids, texts, held = [], [], 0
        for doc, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            texts.append((raw.as_py() or b"").split())  # splits at ASCII white space
            ids.append(doc)
            held += len(texts[-1])
            if held >= BATCH_WORDS:
                yield pack(ids, texts)
                ids, texts, held = [], [], 0
        if ids:
            yield pack(ids, texts)
    free_memory()


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period in words, sorted by start and period) and
    ``collapsed``, the text's words joined by single spaces without those that repeat an earlier period
    of a run. One pass over the scan's partitions; nothing is shuffled."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return src.mapInArrow(_run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
