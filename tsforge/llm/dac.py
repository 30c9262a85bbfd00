"""Directly addressable codes for token ids: random access to any token without decoding blocks.

An id is split into chunks of ``width`` bits. Level 1 holds the low chunk of every id, level 2 the
next chunk of those ids that have one, and so on. A bitmap for each level says which of its entries
continue, and a rank directory (ones before each 512-bit block) turns a position into the position
at the next level, so reading one id touches one chunk, one directory entry and at most one block
of bits for each level.

A file is a row of segments of whole documents, so that writing holds one segment at a time, and a
directory at the end: for each segment uint64 byte offset, byte length, ids before it and documents
before it; then the uint64 number of segments and the magic ``DACE``. A segment, little-endian: the
magic ``DAC1``; unsigned 32-bit chunk width, level count; unsigned 64-bit token and document counts;
document ids (int64); document offsets (uint64, one more than documents); then for each level:
uint64 entry count, chunks (uint8 or uint16), bitmap (uint64 words, least significant bit first),
rank directory (uint64, one for each block of 8 words).

Cases: a null id is kept as null; null and empty texts hold only their end id; an empty partition
makes no file and an empty table gives no rows; other columns are ignored; equal ids are stored one
after the other, in order of their texts.
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import materialize, open_fs, shared_dir
from .token_files import SEGMENT_IDS, ascending, doc_id_array, put_file, segments, shard_number

BLOCK_WORDS = 8  # 512 bits
_ONE = np.uint64(1)


def build(ids: np.ndarray, width: int = 8) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, bitmap words, rank directory) for an array of unsigned ids."""
    kind = np.uint8 if width == 8 else np.uint16
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        more = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
        bits = more > 0
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(-(-max(len(bits), 1) // 64 // 1) + 1, "<u8")
        words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(words).astype(np.uint64)
        cum = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        levels.append(((rest & np.uint32((1 << width) - 1)).astype(kind), words, cum[:-1:BLOCK_WORDS].copy()))
        rest = more[bits]
        if not len(rest):
            return levels


def dump(doc_ids: np.ndarray, offsets: np.ndarray, ids: np.ndarray, width: int = 8):
    levels = build(ids, width)
    yield b"DAC1" + struct.pack("<IIQQ", width, len(levels), len(ids), len(doc_ids))
    yield doc_ids.astype("<i8").tobytes()
    yield offsets.astype("<u8").tobytes()
    for chunks, words, ranks in levels:
        yield struct.pack("<Q", len(chunks))
        yield from (chunks.tobytes(), words.tobytes(), ranks.tobytes())


class FileArray:
    """An array in an open file: indexing reads just those items (items less than ``GAP`` bytes apart in
    one call)."""

    GAP = 4096

    def __init__(self, f, at: int, kind, n: int):
        self.f, self.at, self.kind, self.n = f, at, np.dtype(kind), n

    def __len__(self) -> int:
        return self.n

    def _read(self, lo: int, hi: int) -> np.ndarray:
        size = self.kind.itemsize
        return np.frombuffer(self.f.read_at((hi - lo) * size, self.at + lo * size), self.kind)

    def __getitem__(self, key):
        if isinstance(key, slice):
            lo, hi, _ = key.indices(self.n)
            return self._read(lo, max(lo, hi))
        if np.ndim(key) == 0:
            return self._read(int(key), int(key) + 1)[0]
        u, inv = np.unique(np.asarray(key, np.int64), return_inverse=True)
        out = np.empty(len(u), self.kind)
        cut = [0, *(np.flatnonzero(np.diff(u) * self.kind.itemsize > self.GAP) + 1).tolist(), len(u)]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            if hi > lo:
                out[lo:hi] = self._read(int(u[lo]), int(u[hi - 1]) + 1)[u[lo:hi] - u[lo]]
        return out[inv]


class Reader:
    """Random access to the ids of one segment: in memory (bytes), or in an open file from ``base`` on,
    of which only the header, directory entries, chunks and words that are asked for are read."""

    def __init__(self, raw, base: int = 0):
        stored = hasattr(raw, "read_at")

        def head(at: int, size: int) -> bytes:
            return raw.read_at(size, base + at) if stored else bytes(raw[at:at + size])

        def array(kind, n: int, at: int):
            return FileArray(raw, base + at, kind, n) if stored else np.frombuffer(raw, kind, n, at)
        if head(0, 4) != b"DAC1":
            raise ValueError("not a file of directly addressable codes")
        self.width, n_levels, self.n, n_docs = struct.unpack("<IIQQ", head(4, 24))
        at, kind = 28, np.dtype(np.uint8 if self.width == 8 else np.uint16)
        self.doc_ids, self.offsets = array("<i8", n_docs, at), array("<i8", n_docs + 1, at + 8 * n_docs)
        at += 8 * (2 * n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (m,) = struct.unpack("<Q", head(at, 8))
            chunks = array(kind, m, at + 8)
            at += 8 + m * kind.itemsize
            n_words = -(-max(m, 1) // 64) + 1
            n_ranks = -(-n_words // BLOCK_WORDS)
            self.levels.append((chunks, array("<u8", n_words, at), array("<u8", n_ranks, at + 8 * n_words)))
            at += 8 * (n_words + n_ranks)

    @staticmethod
    def _rank(words: np.ndarray, ranks: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Ones before each position: the directory's entry and the block's own words."""
        word = pos >> 6
        block = word // BLOCK_WORDS
        out = ranks[block].astype(np.int64)
        for k in range(BLOCK_WORDS - 1):
            w = block * BLOCK_WORDS + k
            inside = w < word
            if inside.any():
                out[inside] += np.bitwise_count(words[w[inside]]).astype(np.int64)
        low = (_ONE << (pos & 63).astype(np.uint64)) - _ONE
        return out + np.bitwise_count(words[word] & low).astype(np.int64)

    def get(self, pos) -> np.ndarray:
        """Ids at any positions."""
        pos = np.asarray(pos, np.int64)
        out = np.zeros(len(pos), np.uint64)
        where = np.arange(len(pos))
        for k, (chunks, words, ranks) in enumerate(self.levels):
            out[where] |= chunks[pos].astype(np.uint64) << np.uint64(k * self.width)
            on = (words[pos >> 6] >> (pos & 63).astype(np.uint64)) & _ONE > 0
            if not on.any():
                break
            where, pos = where[on], self._rank(words, ranks, pos[on])
        return out

    def span(self, lo: int, hi: int) -> np.ndarray:
        """Ids of positions lo to hi: one rank for each level, for a run needs no more."""
        out = np.zeros(hi - lo, np.uint32)
        where, first, n = np.arange(hi - lo), lo, hi - lo
        for k, (chunks, words, ranks) in enumerate(self.levels):
            out[where] |= chunks[first:first + n].astype(np.uint32) << np.uint32(k * self.width)
            w0 = first >> 6
            bits = np.unpackbits(words[w0:((first + n + 63) >> 6) + 1].view(np.uint8), bitorder="little")
            on = bits[first - (w0 << 6):][:n].astype(bool)
            if not on.any():
                break
            first = int(self._rank(words, ranks, np.array([first]))[0])
            where = where[on]
            n = len(where)
        return out

    def document(self, i: int) -> np.ndarray:
        return self.span(int(self.offsets[i]), int(self.offsets[i + 1]))


def file_chunks(segs, width: int, log: list):
    """Bytes of a file made of ``segs``, (document ids, ids, offsets) each; ``log`` gets (byte
    offset, bytes, ids before, documents before) for each segment and the totals at its end."""
    at = ids_before = docs_before = 0
    for doc_ids, ids, offsets in segs:
        size = 0
        for c in dump(doc_ids, offsets, ids, width):
            size += len(c)
            yield c
        log.append((at, size, ids_before, docs_before))
        at, ids_before, docs_before = at + size, ids_before + len(ids), docs_before + len(doc_ids)
    yield b"".join(struct.pack("<QQQQ", *x) for x in log) + struct.pack("<Q", len(log)) + b"DACE"
    log.append((at, 0, ids_before, docs_before))


class CodeFile:
    """A file of segments: reads the directory, and of a segment only what is asked for (``segment``:
    all of it, for reading in order)."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        tail = self.f.read_at(12, size - 12)
        if tail[8:] != b"DACE":
            raise ValueError("not a file of directly addressable codes")
        (n,) = struct.unpack("<Q", tail[:8])
        self.dir = np.frombuffer(self.f.read_at(32 * n, size - 12 - 32 * n), "<u8").reshape(n, 4).astype(np.int64)

    def segment(self, k: int) -> Reader:
        return Reader(self.f.read_at(int(self.dir[k, 1]), int(self.dir[k, 0])))

    def part(self, k: int) -> Reader:
        return Reader(self.f, int(self.dir[k, 0]))

    def document(self, i: int) -> tuple[int, np.ndarray]:
        """Id and token ids of the file's i-th document."""
        k = int(np.searchsorted(self.dir[:, 3], i, "right")) - 1
        r = self.part(k)
        return int(r.doc_ids[i - int(self.dir[k, 3])]), r.document(i - int(self.dir[k, 3]))

    def get(self, pos) -> np.ndarray:
        """Ids at any positions of the file."""
        pos = np.asarray(pos, np.int64)
        of = np.searchsorted(self.dir[:, 2], pos, "right") - 1
        out = np.zeros(len(pos), np.uint64)
        for k in np.unique(of).tolist():
            at = of == k
            out[at] = self.part(k).get(pos[at] - self.dir[k, 2])
        return out


def write_codes(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, shards: int | None = None,
                width: int = 8, id_col: str = "doc_id", text_col: str = "text", segment_ids: int = SEGMENT_IDS,
                special: bool = False) -> DataFrame:
    """Encode whole texts and write the shards. Returns the manifest (shard, path, n_tokens,
    n_docs), itself kept as a table, with ``start``: the ids in all shards before."""
    folder = folder or shared_dir(docs.sparkSession, "dac")

    def write(it):
        segs = segments(it, tokenizer, end, segment_ids, special)
        first = next(segs, None)
        if first is not None:
            shard, log = shard_number(), []
            path = put_file(folder, f"shard-{shard:06d}.dac", file_chunks(chain([first], segs), width, log))
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_tokens": [log[-1][2]], "n_docs": [log[-1][3]]})

    made = materialize(ascending(docs, shards, id_col, text_col).mapInArrow(
        write, "shard long, path string, n_tokens long, n_docs long"))
    # one row for each file, so a single window over them stays small
    return materialize(made.selectExpr("*", "sum(n_tokens) OVER (ORDER BY shard) - n_tokens AS start"))


def read_documents(manifest: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32."""
    def read(it):
        for b in it:
            for path, base in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                f = CodeFile(path)
                for k in range(len(f.dir)):
                    r = f.segment(k)
                    ids, at = r.span(0, r.n).astype("<u4"), r.offsets.tolist()
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [doc_id_array(r.doc_ids), pa.array(r.offsets[:-1] + base + int(f.dir[k, 2])), pa.array(np.diff(r.offsets)),
                         pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return manifest.select("path", "start").repartition(tasks or max(1, manifest.count())).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")
