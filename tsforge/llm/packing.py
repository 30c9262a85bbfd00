"""Packing: bounded-space online best fit with a fixed number of open windows per partition.

Each partition streams its documents, cuts them into pieces of at most ``seq_len`` ids, and places
each piece into the open window it fills best. When no open window has room, the fullest one is
emitted and a new one opened, so a task never holds more than ``open_windows`` windows. Windows
still open at the end of their partition are merged in groups of ``fan`` partitions: best fit on
whole windows first; what is still loose is laid end to end and cut at window borders.

Cases: a null text is empty; an empty document still has its end id; a null or repeated id makes
pieces of its own for each row; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_memory, materialize
from .tokens import CACHE_PIECES, encoder, slices

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int32())])


class Windows:
    """At most ``space`` open windows; ``put`` returns the window that had to be closed, if any."""

    def __init__(self, seq_len: int, space: int):
        self.seq_len, self.space = seq_len, space
        self.room: list[tuple[int, int]] = []  # (room left, window number), ascending
        self.held: dict[int, list] = {}
        self.made = 0

    def put(self, size: int, item) -> list:
        closed = []
        k = bisect_left(self.room, (size, -1))
        if k < len(self.room):  # the least room that is enough: best fit
            left, w = self.room.pop(k)
        else:
            if len(self.room) >= self.space:  # none fits: the fullest goes
                closed.append(self._take(0))
            left, w = self.seq_len, self.made
            self.made += 1
            self.held[w] = []
        self.held[w].append(item)
        if left == size:
            closed.append((w, self.held.pop(w)))
        else:
            insort(self.room, (left - size, w))
        return closed

    def _take(self, k: int):
        _, w = self.room.pop(k)
        return w, self.held.pop(w)

    def rest(self) -> list:
        return [self._take(0) for _ in range(len(self.room))]


def _rows(windows: list, base: int, part: int) -> pa.RecordBatch:
    """Piece rows of windows [(number, [(doc, start, ids, doc_tokens)])]."""
    cols: list[list] = [[] for _ in range(7)]
    for w, items in windows:
        at = 0
        for doc, start, ids, total in items:
            for c, v in zip(cols, (doc, start, ids.astype("<u4").tobytes(), total, base + w, at, part), strict=True):
                c.append(v)
            at += len(ids)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA, strict=True)], schema=_SCHEMA)


def _pack_partition(path: str, end: int, seq_len: int, space: int, special: bool = False, call_chars: int = 4_000_000,
                    cache: int = CACHE_PIECES):
    def run(it):
        enc, part = encoder(path, special, cache), TaskContext.get().partitionId()
        win, out, base = Windows(seq_len, space), [], part << 32
        for b in it:
            ids_col, texts = b.column(0).to_pylist(), b.column(1)
            for lo, hi in slices(texts, call_chars):
                ids, at = enc.encode(texts[lo:hi], end)
                for d, s, e in zip(ids_col[lo:hi], at[:-1].tolist(), at[1:].tolist(), strict=True):
                    for p in range(s, e, seq_len):
                        piece = ids[p:min(p + seq_len, e)].copy()  # a window left open must not hold all ids of the call
                        out += win.put(len(piece), (d, p - s, piece, e - s))
                if len(out) >= 256:
                    yield _rows(out, base, -1)
                    out = []
        yield _rows(out, base, -1)
        yield _rows(win.rest(), base, part)
        free_memory()
    return run


def _merge_group(seq_len: int, fan: int):
    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in t.column("ids").to_pylist()]
        rows = list(zip(t.column("doc_id").to_pylist(), t.column("start").to_pylist(), ids,
                        t.column("doc_tokens").to_pylist(), strict=True))
        old: dict[int, list] = {}
        for s, r in zip(t.column("sequence_id").to_pylist(), rows, strict=True):
            old.setdefault(s, []).append(r)
        units = sorted(((sum(len(r[2]) for r in w), s) for s, w in old.items()), key=lambda u: (-u[0], u[1]))
        win, full = Windows(seq_len, len(units) + 1), []
        for size, s in units:
            full += win.put(size, old[s])
        full = [(w, [r for u in held for r in u]) for w, held in full]
        loose = []
        for w, held in win.rest():
            items = [r for u in held for r in u]
            if sum(len(r[2]) for r in items) >= 0.98 * seq_len:
                full.append((w, items))
            else:
                loose += items
        at, w = seq_len, win.made  # loose pieces end to end, cut at window borders
        tail: list = []
        for doc, start, x, total in loose:
            while len(x):
                if at == seq_len:
                    tail.append((w, []))
                    at, w = 0, w + 1
                take = x[:seq_len - at]
                tail[-1][1].append((doc, start, take, total))
                start, x, at = start + len(take), x[len(take):], at + len(take)
        group = table.column("part")[0].as_py() // fan
        return pa.Table.from_batches([_rows(full + tail, ((1 << 30) + group) << 32, -1)]).drop_columns(["part"])
    return run


def pack(docs: DataFrame, tokenizer: str, end: int, seq_len: int = 4096, open_windows: int = 64, fan: int = 8,
         id_col: str = "doc_id", text_col: str = "text", special: bool = False, call_chars: int = 4_000_000,
         cache: int = CACHE_PIECES) -> DataFrame:
    """Pack the ids of ``docs`` into sequences of at most ``seq_len``. Returns one row for each
    piece: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    The packed pieces are written once to the shared folder: full windows are read from there as
    they are, and only windows left open (at most ``open_windows`` for each partition) are shuffled.
    ``call_chars`` is the text that the tokenizer gets at once, ``cache`` the pieces that a worker
    remembers: less takes less memory and more time.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = materialize(src.mapInArrow(_pack_partition(tokenizer, end, seq_len, open_windows, special, call_chars, cache), PIECES + ", part int"))
    loose = pieces.where("part >= 0").withColumn("grp", F.floor(F.col("part") / F.lit(fan)))
    merged = loose.groupBy("grp").applyInArrow(lambda t: _merge_group(seq_len, fan)(t.drop_columns(["grp"])), PIECES)
    return pieces.where("part < 0").drop("part").unionByName(merged)
