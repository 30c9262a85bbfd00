"""Token ids of whole texts with a public tokenizer file, by parts that are remembered.

A text is cut only where the tokenizer's own pre-splitting is certain to cut too, so the ids of the
parts in order are the ids of the text. First it is cut into pieces, between a printable
non-space character, one space, and a printable non-space character. Pieces repeat, so a bounded cache of their
ids serves most of them. A new piece of plain Latin letters, digits and ASCII punctuation is cut on
into runs of each, which repeat more often still; new runs go through the tokenizer together, and
its own word numbers tell their ids apart. All other pieces are encoded one by one, and texts with
the shape of a special token whole.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import listed

CACHE_PIECES = 160_000  # pieces that a Python worker remembers; frequent ones come early, so it then
CACHE_RUNS = 400_000    # keeps those and holds others for one call only. The same for runs, of
                        # which a worker remembers at most 5 for each 2 pieces
_SAFE = re.compile(r"(?<=[^\s\x00-\x20\x7f-\xa0]) (?=[^\s\x00-\x20\x7f-\xa0])")
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_PUNCT = r"!-&(-/:-@\[-`{-~"  # ASCII, without the apostrophe
_MARK = "\x01"
_FIRST = "\x02"  # leads the key of a piece with no space before it
_PLAIN = re.compile(rf"{_FIRST}?[{_LETTER}0-9{_PUNCT}]+(?:\n[{_LETTER}0-9{_PUNCT}]+)*")
_STEP = 256  # runs in one call; the tokenizer's cost grows faster than the text
_ENCODERS: dict = {}


def encoder(path: str, special: bool = False, pieces: int = CACHE_PIECES) -> "PieceEncoder":
    """The worker's encoder for a tokenizer file (one for each process), which remembers ``pieces``. With ``special``, strings like
    ``<|endoftext|>`` in a text become the special tokens' ids, as in the library's own call; without, they
    are ordinary text."""
    key = path, special, pieces
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, special, pieces)
    return _ENCODERS[key]


class Store:
    """Ids of texts: a dictionary of positions beside flat arrays. Up to ``room`` texts stay; what
    comes after is dropped by ``trim``."""

    def __init__(self, room: int):
        self.room = room
        self.at: dict[str, int] = {}
        self.over: dict[str, int] = {}
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used, self.count = np.zeros(1 << 18, np.int32), 0, 0
        self.kept_used = 0

    def trim(self) -> None:
        if self.over:
            self.over, self.count, self.used = {}, len(self.at), self.kept_used

    def add(self, texts: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = self.count, len(texts)
        while n + k > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[n:n + k] = self.used + np.cumsum(lengths) - lengths
        self.length[n:n + k] = lengths
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.count += k
        stay = not self.over and len(self.at) + k <= self.room
        (self.at if stay else self.over).update(zip(texts, range(n, n + k), strict=True))
        if stay:
            self.kept_used = self.used

    def find(self, texts: list[str], learn=None) -> np.ndarray:
        """Positions of texts; those that are not there are first given to ``learn``."""
        at = np.fromiter(map(self.at.get, texts, repeat(-1)), np.int64, len(texts))
        gone = np.flatnonzero(at < 0)
        if len(gone):
            new = [texts[i] for i in gone.tolist()]
            learn([t for t in dict.fromkeys(new) if t not in self.over])
            over, get = self.over, self.at.get
            at[gone] = [over[t] if t in over else get(t) for t in new]
        return at

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids at positions, in a row, and how many each position has."""
        n = self.length[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(at) else 0
        return self.flat[np.arange(total) - np.repeat(ends - n - self.start[at], n)], n


class PieceEncoder:
    def __init__(self, path: str, special: bool = False, pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        marks = [t.content for t in self.tok.get_added_tokens_decoder().values()] if special else []
        self.special = re.compile("|".join(map(re.escape, marks))) if marks else None
        # whether a leading space is part of the piece after it, and whether case is kept
        self.spaced = self._whole(" a") != self._whole("a")
        self.cased = self._whole("A") != self._whole("a")
        lead = " ?" if self.spaced else ""
        digits = "[0-9]+" if self.spaced else "[0-9]"
        line = "|\n" if self.spaced else ""
        self.runs = re.compile(f"{lead}[{_LETTER}]+|{lead}{digits}|{lead}[{_PUNCT}]+|{_MARK}{line}")
        if hasattr(self.tok.model, "_resize_cache"):
            self.tok.model._resize_cache(0)  # runs are remembered here
        self.pieces, self.parts, self.risky = Store(pieces), Store(min(CACHE_RUNS, 5 * pieces // 2)), np.zeros(0, bool)

    def _marked(self, text: str) -> bool:
        """Whether a special token stands in the text, which is then encoded as a whole."""
        return self.special is not None and self.special.search(text) is not None

    def _whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(got)), np.int64), np.array([len(g) for g in got], np.int64)

    def _learn_runs(self, new: list[str]) -> None:
        """Runs that were not seen before. Joined so that each stays a word of the tokenizer's
        own splitting: as they are if they begin with a space, else by a space or line end that
        is a word itself (or none)."""
        for own in ([r for r in new if r[0] == " "], [r for r in new if r[0] != " "]):
            sep, every = ("", 1) if own and own[0][0] == " " else ("\n", 2) if self.spaced else (" ", 1)
            for lo in range(0, len(own), _STEP):
                some = own[lo:lo + _STEP]
                e = self.tok.encode(sep.join(some), add_special_tokens=False)
                word, ids = np.array(e.word_ids, np.int64), np.array(e.ids, np.int64)
                if len(word) and int(word[-1]) == every * (len(some) - 1):
                    keep = word % every == 0
                    self.parts.add(some, ids[keep], np.bincount(word[keep] // every, minlength=len(some)))
                else:
                    self.parts.add(some, *self._one_by_one(some))

    def _learn(self, new: list[str]) -> None:
        """Pieces that were not seen before. A piece that begins a text, or follows a cut that is
        not a space, is written with a leading mark if spaces are part of pieces."""
        plain, odd, looks_plain = [], [], _PLAIN.fullmatch
        marked = self._marked(_MARK.join(new))  # one search for all: no special token spans two pieces
        for p in new:
            (plain if looks_plain(p) and not (marked and self._marked(p)) else odd).append(p)
        if odd:
            self.pieces.add(odd, *self._one_by_one([self._text(p) for p in odd]))
            bare = [p[1:] if p[:1] == _FIRST else p for p in odd]
            flags = [not u or not (u[0].isprintable() and u[-1].isprintable()) or "<|" in u or _MARK in u or _FIRST in u or self._marked(u) for u in bare]
            self.risky = np.concatenate([self.risky, np.array(flags, bool)])
        for lo in range(0, len(plain), 50_000):
            some = plain[lo:lo + 50_000]
            joined = (" " + f"{_MARK} ".join(some)).replace(" " + _FIRST, "") if self.spaced else _MARK.join(some)  # as _text, all at once
            found = self.runs.findall(joined if self.cased else joined.lower())
            marks = np.array([r == _MARK for r in found], bool)
            of = np.cumsum(marks)[~marks]
            ids, n = self.parts.gather(self.parts.find([r for r in found if r != _MARK], self._learn_runs))
            self.pieces.add(some, ids, np.bincount(of, n, minlength=len(some)).astype(np.int64))
            self.risky = np.concatenate([self.risky, np.zeros(len(some), bool)])

    def _text(self, piece: str) -> str:
        return piece if not self.spaced else piece[1:] if piece[:1] == _FIRST else " " + piece

    def _careful(self, text: str) -> list[str]:
        """Pieces of a text with white space in a row or the shape of a special token."""
        if "<|" in text or _MARK in text or self._marked(text):
            return [_FIRST + text] if self.spaced else [text]
        parts = _SAFE.split(text)
        return [_FIRST + parts[0], *parts[1:]] if self.spaced else parts

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (int32), each followed by ``end`` if given, and the offsets
        of the texts in it (one more than texts). Null texts are empty."""
        for store in (self.pieces, self.parts):
            store.trim()
        self.risky = self.risky[:self.pieces.count]
        cut = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), " ")
        of = np.asarray(cut.offsets, np.int64)
        of, words = of - of[0], cut.flatten().dictionary_encode()
        code, uniq = words.indices.to_numpy(), listed(words.dictionary)
        first = code[of[:-1]]
        at = self.pieces.find(uniq, self._learn)[code] if len(uniq) else np.zeros(0, np.int64)
        if self.spaced and len(first):
            at[of[:-1]] = self.pieces.find([_FIRST + uniq[c] for c in first.tolist()], self._learn)
        per = np.diff(of)
        odd = np.flatnonzero(np.logical_or.reduceat(self.risky[at], of[:-1])) if len(first) else []
        if len(odd):  # put in the pieces of such texts instead
            parts, last = [], 0
            for i in odd.tolist():
                text = texts[i].as_py() or ""
                own = self.pieces.find(self._careful(text), self._learn) if text else np.zeros(0, np.int64)
                parts += [at[last:of[i]], own]
                last, per[i] = of[i + 1], len(own)
            at = np.concatenate([*parts, at[last:]])
        ids, n = self.pieces.gather(at)
        total = np.concatenate([[0], np.cumsum(n)])
        bounds = total[np.concatenate([[0], np.cumsum(per)]).astype(np.int64)].astype(np.int64)
        if end is not None and len(texts):
            ids = np.insert(ids, bounds[1:], end)
            bounds = bounds + np.arange(len(texts) + 1)
        return ids.astype(np.int32, copy=False), bounds


def slices(texts: pa.Array, chars: int = 4_000_000):
    """Consecutive (from, to) of ``texts`` with about ``chars`` bytes each, so that the pieces of
    one call stay small."""
    size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + chars, "right")))
        yield lo, hi
        lo = hi
