"""Words are split and looked up in Arrow columns: the same words, counts and pairs as text by text."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_text_operators import NASTY
from tsforge.llm import brown

TEXTS = [t for _, t in NASTY] + ["ÀB İ K", "\x0b\x0ca\r\n b\t", "a\x1cb\xa0c\x85d", "", None, "Aa aA " * 50]


def plain(t):
    return brown.words_of(t or "")


def test_words_of_slices_are_those_of_each_text():
    whole = pa.array(TEXTS * 3)
    for lo, hi in ((0, len(whole)), (3, 9), (7, len(whole)), (len(TEXTS) - 1, len(TEXTS) + 4), (2, 2)):
        flat, n = brown.words_in(whole[lo:hi])
        want = [plain(t) for t in whole[lo:hi].to_pylist()]
        assert n.tolist() == [len(w) for w in want] and flat.to_pylist() == [x for w in want for x in w]


def batch(texts, held, chunks):
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(held, pa.bool_()), pa.array(texts, pa.string())],
                                      names=["chunk", "held_out", "text"])


@pytest.mark.parametrize("most", [1, 20, 400_000])
def test_counts_of_a_chunk(monkeypatch, most):
    monkeypatch.setattr(brown, "MAX_WORDS", most)
    held, chunks = [i % 3 == 0 for i in range(len(TEXTS))], [i % 2 for i in range(len(TEXTS))]
    got, want = Counter(), Counter()
    seen = set()
    for b in brown._count(iter([batch(TEXTS, held, chunks), batch(TEXTS[::-1], held, chunks)])):
        for c, w, n, o in zip(*(b.column(k).to_pylist() for k in ("chunk", "word", "n", "open")), strict=True):
            got[c, w] += n
            seen.add((c, w))
            assert o == brown.open_class(w)
    all_words = set()
    for texts in (TEXTS, TEXTS[::-1]):
        for t, h, c in zip(texts, held, chunks, strict=True):
            all_words |= {(c, w) for w in plain(t)}
            if not h:
                want.update((c, w) for w in plain(t))
    assert seen == all_words and +got == want


def test_pairs_and_lookups_use_no_python_dictionary(monkeypatch):
    """All texts of a chunk in few calls of the lookup, and the pairs are those of each text."""
    words = sorted({w for t in TEXTS for w in plain(t)})
    table = pa.table({"word": pa.array(words, pa.binary()), "open": pa.array([brown.open_class(w) for w in words], pa.int32()),
                      "id": pa.array([i + 2 if i % 2 else None for i in range(len(words))], pa.int32())})
    base, calls = len(words) + 2, []
    real = brown.pc.index_in

    class Spy:
        def __getattr__(self, name):
            return getattr(pa.compute, name)

        def index_in(self, *a, **k):
            calls.append(1)
            return real(*a, **k)
    monkeypatch.setattr(brown, "pc", Spy())
    number = {w: i + 2 if i % 2 else base + brown.open_class(w) for i, w in enumerate(words)}
    want = Counter()
    for t in TEXTS:
        path = [brown.START, *map(number.get, plain(t)), brown.END]
        want.update(zip(path[:-1], path[1:], strict=True))
    for most in (7, 1_000_000):
        monkeypatch.setattr(brown, "PAIR_TOKENS", most)
        calls.clear()
        out = brown._pairs(base, 3)(pa.table({"text": pa.array(TEXTS)}), table)
        u, v, n = brown._added(out.column("after").to_pylist())
        assert {(int(a), int(b)): int(c) for a, b, c in zip(u, v, n, strict=True)} == want and len(calls) == 1
    with pytest.raises(RuntimeError, match="differ"):
        brown._pairs(base, 3)(pa.table({"text": ["never seen here"]}), table)
    assert np.array_equal(brown._paths(np.array([5, 6, 7]), np.array([2, 0, 1]), 1, 0)[0], [1, 5, 6, 0, 1, 0, 1, 7, 0])
