"""Language identification with word-first backoff.

For each language the corpus gives the relative frequency of every word and of every character
n-gram of its words (a space stands at either end of a word), counted over all training texts. A
word that some language knows scores log10 of its frequency in each language. A word that none knows
falls back to its longest character n-grams, then to shorter ones until some of its n-grams are
known, and scores the mean over these. The text's language is the one with the highest sum over its
words; the score is its share when the sums are taken as log-likelihoods under equal priors.

A language knows an item from a share of ``FLOOR`` of its words (or of its n-grams of one length) on,
so it holds at most 1 / FLOOR items of a kind however large the corpus is, and the model's size is
bounded by the number of languages alone. An item that a language does not know counts as ten times
rarer than the floor.

Cases: words are runs of letters in lower case; a text that is null or has no letter gets
``und`` and score 0; with nothing learned every text does; equal sums go to the language with more
training words, then to the first by name; texts are read whole; repeated rows and ids each get a
row; rows with a null language or text are not learned from; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import batches, discard, free_memory, materialize

FLOOR = 1e-5
LONGEST = 5           # characters of the longest n-gram
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_DISTINCT = 200_000   # distinct words that a task holds before it passes their counts on, or forgets them
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """The text's words: runs of letters, in lower case."""
    found = _WORD.findall(text.lower())
    # numeric signs that are no digits (like superscripts) match the pattern but are no letters
    return found if text.isascii() else [w for w in found if w.isalpha()]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def ngram_hashes(words: list[str], longest: int = LONGEST):
    """(n, word number, hash) for n from 1 to ``longest``: the character n-grams of the words between
    spaces. An n-gram holds at least one letter and never runs over the end of its word."""
    joined = " " + "  ".join(words) + " "
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(c))  # characters to the end of the word's space
    letter = c != 32
    h = _mix(c + np.uint64(1))
    for n in range(1, longest + 1):
        if n > 1:
            h = _mix(h[:len(c) - n + 1] * _STEP + c[n - 1:])
        ok = left[:len(h)] >= n
        if n == 1:
            ok = ok & letter
        yield n, word[:len(h)][ok], h[ok]
        h = h if n == longest else h[:max(0, len(c) - n)]


def _signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a, np.uint64).view(np.int64)


def _count(it):
    """Rows (text, lang) -> (lang, n, h, c): counts of words (n = 0) and of n-grams."""
    def rows(held: dict):
        out = [[], [], [], []]
        for lang, count in held.items():
            words, c = list(count), np.fromiter(count.values(), np.int64, len(count))
            for n, at, h in [(0, np.arange(len(words)), word_hashes(words)), *ngram_hashes(words)]:
                u, inv = np.unique(h, return_inverse=True)
                out[0].append(pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(u), np.int32)), pa.array([lang])).cast(pa.string()))
                out[1].append(pa.array(np.full(len(u), n, np.int32)))
                out[2].append(pa.array(_signed(u)))
                out[3].append(pa.array(np.bincount(inv, c[at], len(u)).astype(np.int64)))
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in out], names=["lang", "n", "h", "c"])

    held: dict[str, dict[str, int]] = {}
    for b in it:
        for text, lang in zip(batches(b.column(0)), b.column(1).to_pylist(), strict=True):
            count = held.setdefault(lang, {})
            for w in words_of(text):
                count[w] = count.get(w, 0) + 1
        if sum(map(len, held.values())) > _DISTINCT:
            yield from rows(held)
            held = {}
    yield from rows(held)
    free_memory()


class Model:
    """langs (more training words first), and for each kind n (0: words) the sorted hashes and a row
    of log10 frequencies for each."""

    def __init__(self, langs: list[str], tables: list[tuple[np.ndarray, np.ndarray]], absent: float):
        self.langs, self.tables, self.absent = langs, tables, absent

    def _look_up(self, n: int, h: np.ndarray) -> np.ndarray:
        keys = self.tables[n][0]
        if not len(keys):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, at, -1)

    def score_words(self, words: list[str]) -> np.ndarray:
        """A row of log10 scores, one for each language, for each word."""
        out = np.full((len(words), len(self.langs)), self.absent)
        at = self._look_up(0, word_hashes(words))
        out[at >= 0] = self.tables[0][1][at[at >= 0]]
        open_ = np.flatnonzero(at < 0)
        if not len(open_):
            return out
        grams = list(ngram_hashes([words[i] for i in open_.tolist()]))
        undecided = np.ones(len(open_), bool)
        for n, word, h in reversed(grams):
            use = undecided[word]
            word = word[use]
            at = self._look_up(n, h[use])
            word, at = word[at >= 0], at[at >= 0]
            if not len(at):
                continue
            known = np.bincount(word, minlength=len(open_))
            some = known > 0
            for k in range(len(self.langs)):
                total = np.bincount(word, self.tables[n][1][at, k], len(open_))
                out[open_[some], k] = total[some] / known[some]
            undecided &= ~some
        return out


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", floor: float = FLOOR) -> Model:
    """A model of all texts of ``docs`` that have a language: one pass that counts, a sum by item, and
    the items above the floor (at most 1 / floor for each language and kind) to the driver."""
    src = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = materialize(src.mapInArrow(_count, "lang string, n int, h long, c long").groupBy("lang", "n", "h").agg(F.sum("c").alias("c")))
    totals = counts.groupBy("lang", "n").agg(F.sum("c").alias("total"))  # a few rows for each language
    size = {(r["lang"], r["n"]): r["total"] for r in totals.collect()}
    words = {lang: t for (lang, n), t in size.items() if n == 0}
    langs = sorted(words, key=lambda x: (-words[x], x))
    kept = counts.join(F.broadcast(totals), ["lang", "n"]).where(F.col("c") >= floor * F.col("total")).select("lang", "n", "h", "c").toArrow()
    discard(counts)
    lang, n, h, c = (kept.column(x) for x in ("lang", "n", "h", "c"))
    k = np.array([langs.index(x) for x in lang.to_pylist()], np.int64)
    n, h, c = n.to_numpy(), h.to_numpy().view(np.uint64), c.to_numpy()
    absent = float(np.log10(floor) - 1)
    tables = []
    for kind in range(LONGEST + 1):
        mine = n == kind
        keys, row = np.unique(h[mine], return_inverse=True)
        m = np.full((len(keys), len(langs)), absent)
        total = np.array([size.get((x, kind), 1) for x in langs], float)
        m[row, k[mine]] = np.log10(c[mine] / total[k[mine]])
        tables.append((keys, m))
    return Model(langs, tables, absent)


def _identify(model):
    def run(it):
        m: Model = model.value
        code: dict[str, int] = {}
        memo = np.zeros((0, len(m.langs)))
        for b in it:
            texts = batches(b.column(1))
            langs, scores, n_words, sums = [], [], [], []
            for lo in range(0, len(texts), 256):
                if len(code) > 2 * _DISTINCT:
                    code, memo = {}, memo[:0]
                start = len(code)
                at = [[code.setdefault(w, len(code)) for w in words_of(t)] for t in texts[lo:lo + 256]]
                if len(code) > start:
                    new = [w for w, _ in zip(reversed(code), range(len(code) - start), strict=False)][::-1]
                    memo = np.concatenate([memo, m.score_words(new)])
                for x in at:
                    n_words.append(len(x))
                    sums.append(memo[x].sum(0) if x else None)
            for s in sums:
                if s is None or not len(s):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    best = int(np.argmax(s))
                    langs.append(m.langs[best])
                    scores.append(float(1 / (10.0 ** np.maximum(s - s[best], -300)).sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(n_words, pa.int64())],
                                             names=["doc_id", "lang", "score", "n_words"])
        free_memory()
    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang, score (0 to 1), n_words of every row, in one pass without a shuffle."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see FLOOR
    return src.mapInArrow(_identify(sent), "doc_id long, lang string, score double, n_words long")
