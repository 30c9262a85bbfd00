"""What op9_brown saves: calls of the lookup, logarithms and sorts; the counts and gains stay the same."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tsforge.llm import brown


def test_a_chunks_words_are_looked_up_in_few_calls(monkeypatch):
    texts = [f"w{i} w{i % 7} x" for i in range(200)] + ["", None]
    words = sorted({w for t in texts for w in brown.words_of(t or "")})
    calls, real = [], brown.pc.index_in

    class Spy:
        def __getattr__(self, name):
            return getattr(pa.compute, name)

        def index_in(self, *a, **k):
            calls.append(1)
            return real(*a, **k)
    monkeypatch.setattr(brown, "pc", Spy())
    monkeypatch.setattr(brown, "TEXT_CHARS", 50)
    column, known = pa.chunked_array([pa.array(texts[:90]), pa.array(texts[90:])]), pa.chunked_array([pa.array(words, pa.binary())])
    want = [words.index(w) for t in texts for w in brown.words_of(t or "")]
    for most, n_calls in ((1_500_000, 1), (300, 2), (1, None)):
        monkeypatch.setattr(brown, "LOOKUP_WORDS", most, raising=False)
        calls.clear()
        got = list(brown.places(column, known))
        assert np.concatenate([at for at, _ in got]).tolist() == want
        assert np.concatenate([n for _, n in got]).tolist() == [len(brown.words_of(t or "")) for t in texts]
        assert len(got) > 20 and (n_calls is None or len(calls) == n_calls)


def test_gains_from_the_table_equal_those_of_each_word():
    rng = np.random.default_rng(5)
    nc, first, words = 9, 3, 40
    big = rng.poisson(rng.choice([0.05, 0.6, 30], (words, words)))  # counts on either side of SMALL
    cls = first + np.arange(words) % (nc - first)
    m = np.zeros((nc, nc))
    np.add.at(m, (cls[:, None], cls[None, :]), big)
    onto = np.eye(nc)[cls]
    other = big - np.diag(np.diag(big))
    out, into, same = other @ onto, other.T @ onto, np.diag(big).astype(float)
    assert (out[out > 0] <= brown.SMALL).any() and (out > brown.SMALL).any()
    to = np.tile(np.arange(first, nc), (words, 1))
    got = brown.gains_of(m, cls, out, into, same, to, brown.small_steps(m))
    want = [brown.move_gains(m, int(cls[w]), out[w], into[w], same[w], first) for w in range(words)]
    assert np.allclose(got, want, atol=1e-8)


def test_packs_hold_eight_bytes_a_pair_and_large_counts(monkeypatch):
    rng = np.random.default_rng(6)
    want = Counter({(int(a), int(b)): int(c) for a, b, c in rng.integers(0, 300, (5000, 3)) if c})
    keys = sorted(want)
    i, v = np.array(keys, np.int64).T
    n = np.array([want[k] for k in keys], np.int64)
    sizes, real = [], brown.zstandard.ZstdCompressor

    class Spy:
        def __init__(self, **k):
            self.real = real(**k)

        def compress(self, raw):
            sizes.append(len(raw))
            return self.real.compress(raw)
    monkeypatch.setattr(brown.zstandard, "ZstdCompressor", Spy)
    for counts in (n, n + (1 << 40)):
        assert all(np.array_equal(a, b) for a, b in zip(brown._unpack(brown._pack(i, v, counts)), (i, v, counts), strict=True))
        parts = list(brown._dealt(v, i, counts, 7))
        assert [p for p, _ in parts] == sorted({p for p, _ in parts})
        b, a, c = brown._added([d for _, d in parts] * 2)
        assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), c.tolist(), strict=True)) == dict(zip(keys, (2 * counts).tolist(), strict=True))
    assert sizes[0] < 10 * len(keys)
    assert [len(x) for x in brown._unpack(brown._pack(*[np.zeros(0, np.int64)] * 3))] == [0, 0, 0]


@pytest.mark.parametrize("least", [3])
def test_words_are_counted_and_numbered_with_one_window_and_no_sorted_join(spark, monkeypatch, least):
    docs = spark.createDataFrame([(i, f"a b{i % 5} c{i} A") for i in range(60)] + [(60, None), (61, "")], "doc_id long, text string").repartition(3)
    plans, real = [], brown.materialize

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)
    monkeypatch.setattr(brown, "materialize", kept)
    chunks = brown.chunked(brown.reuse_input(docs), "doc_id", "text", lambda c: F.col(c) % 4 == 0)
    vocab, base = brown.numbered(brown.count_words(chunks), least)
    rows = vocab.collect()
    assert len(re.findall(r"\bWindow \[", plans[0])) == 1
    assert "SortMergeJoin" not in plans[1]
    want = Counter(w for i in range(60) if i % 4 for w in (b"a", b"b%d" % (i % 5), b"c%d" % i, b"a"))
    assert {bytes(r["word"]) for r in rows} == {b"a", *(b"b%d" % i for i in range(5)), *(b"c%d" % i for i in range(60))}
    assert all(r["c"] == want[bytes(r["word"])] and (r["id"] is not None) == (r["c"] >= least) for r in rows)
    assert Counter(bytes(r["word"]) for r in rows if r["lead"]) == Counter({bytes(r["word"]) for r in rows})
    ids = {bytes(r["word"]): r["id"] for r in rows if r["id"] is not None}
    assert len(set(ids.values())) == len(ids) and max(ids.values()) == base - 1 and min(ids.values()) >= 2
