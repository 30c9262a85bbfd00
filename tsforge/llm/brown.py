"""LM scoring by class-based n-grams (Brown classes found by exchange).

    p(w_i | w_(i-1)) = p(class(w_i) | class(w_(i-1))) p(w_i | class(w_i))

Every word seen at least ``min_count`` times in training gets its class by exchange clustering: in
each round every word weighs moves by the exact change in the training likelihood, computed from its
neighbour-class counts, to the classes of largest first-order change (``SHORTLIST``). A share of the words that gain by a move moves at a time; a
round that does not help is undone and the share halved. Rounds go on until one gains less than
``tol`` (nats a training token, as if all had moved). Rarer words, and words never seen, belong to
open classes by their ending, whose emission is add-one smoothed with room for one unseen word.
Transitions are smoothed towards the class shares.

Counts cover the whole training corpus and are made in tasks, shuffled, and kept as tables, and so are
the words and their numbers. The driver holds, and tasks get, the class matrix and the class of each
clustered word by its number (2 bytes a word), never the words. The passes that build pairs and
score bring to each chunk of documents just the words in that chunk (cogrouped by chunk).

Cases: null and empty texts are a single end token; a null id counts as the empty text for the
hold-out rule; rows that repeat an id or a text each count and each get a row; very long texts are
scored whole; without training rows every count is 0; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reuse_input
from .common import discard, free_memory, listed, materialize, parts_for, run_bounds
from .tokens import slices

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END, START = 0, 1       # ids and classes of the end token and of the start of a text
OPEN = 64               # open classes
MAX_WORDS = 400_000     # words counted in a task before the counts are passed on
CHUNK_BYTES = 16 << 20  # of input files for each chunk
PAIR_TOKENS = 1_000_000  # whose pairs a task counts at a time
TEXT_CHARS = 4_000_000  # of text split at a time
LOOKUP_WORDS = 1_500_000  # split before they are looked up in one call
SMALL = 8               # counts up to this, of a word with a class, take their logarithms from a table
SHORTLIST = 8           # classes whose gains a round computes exactly for a word


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` all texts in a row, and how many each text has. Null texts have none."""
    own = texts.take(pa.array(np.arange(len(texts))))  # a copy: ascii_lower reads amiss what is sliced from a longer array
    cut = pc.ascii_split_whitespace(pc.ascii_lower(own.cast(pa.large_string()).fill_null("")))
    of, flat = np.asarray(cut.offsets, np.int64), cut.flatten().cast(pa.large_binary())
    of = of - of[0]
    some = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty one
    if not some.all():
        of = np.concatenate([[0], np.cumsum(some)])[of]
        flat = flat.filter(pa.array(some))
    return flat, np.diff(of)


def places(texts: pa.ChunkedArray, words: pa.ChunkedArray):
    """For some texts at a time: the places in ``words`` of all their words in a row, and how many each
    text has."""
    kind = pa.binary() if words.nbytes < 1 << 31 else pa.large_binary()
    known = pa.concat_arrays([c.cast(kind) for c in words.chunks]) if words.num_chunks else pa.array([], kind)
    waiting, held = [], 0

    def look():  # a call hashes all of ``known`` first
        at = pc.index_in(pa.chunked_array([flat for flat, _ in waiting]), value_set=known)
        if at.null_count:
            raise RuntimeError("a chunk's words differ between two scans of the same input")
        counts, lo = [n for _, n in waiting], 0
        waiting.clear()
        for n in counts:
            hi = lo + int(n.sum())
            yield at.slice(lo, hi - lo).to_numpy(), n
            lo = hi

    for whole in texts.chunks:
        for lo, hi in slices(whole, TEXT_CHARS):
            flat, n = words_in(whole[lo:hi])
            waiting.append((flat.cast(kind), n))
            held += len(flat)
            del flat
            if held >= LOOKUP_WORDS:
                yield from look()
                held = 0
    if waiting:
        yield from look()


def _paths(tokens: np.ndarray, n: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's tokens between ``start`` and ``end``, in a row, and the offsets of the texts in it."""
    at = np.concatenate([[0], np.cumsum(n + 2)])
    out, own = np.empty(int(at[-1]), np.int64), np.ones(int(at[-1]), bool)
    own[at[:-1]] = own[at[1:] - 1] = False
    out[at[:-1]], out[at[1:] - 1], out[own] = start, end, tokens
    return out, at


def open_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % OPEN


def chunked(docs: DataFrame, id_col: str, text_col: str, held_out) -> DataFrame:
    """(chunk, doc_id, held_out, text). A chunk is a share of one scan partition; the same files
    and settings give the same chunks, and scoring fails loudly if they ever differ."""
    spark = docs.sparkSession
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    share = max(1, -(-int(split) // CHUNK_BYTES))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.select((F.spark_partition_id() * share + F.pmod(F.xxhash64("doc_id"), F.lit(share)).cast("int")).alias("chunk"),
                      "doc_id", held_out("doc_id").alias("held_out"), "text")


def _count(it):
    """Words of each chunk with their training counts (0 if only held-out texts have them)."""
    held: dict[int, list[tuple[pa.Array, np.ndarray]]] = defaultdict(list)

    def merge():
        for chunk, got in held.items():
            if len(got) > 1:
                all_words = pa.concat_arrays([w for w, _ in got]).dictionary_encode()
                n = np.bincount(all_words.indices.to_numpy(), np.concatenate([c for _, c in got]), len(all_words.dictionary))
                held[chunk] = [(all_words.dictionary, n.astype(np.int64))]

    def rows():
        merge()
        for chunk, ((ws, n),) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ws), chunk, np.int32)), ws.cast(pa.binary()), pa.array(n),
                 pa.array([open_class(w) for w in listed(ws)], pa.int32())], names=["chunk", "word", "n", "open"])
        held.clear()

    def size():
        return sum(len(w) for got in held.values() for w, _ in got)

    for b in it:
        chunks, train = b.column("chunk").to_numpy(), ~b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for chunk in np.unique(chunks).tolist():
            mine = chunks == chunk
            texts, trains = b.column("text").filter(pa.array(mine)), train[mine]
            for lo, hi in slices(texts, TEXT_CHARS):
                flat, n = words_in(texts[lo:hi])
                found = flat.dictionary_encode()
                counts = np.bincount(found.indices.to_numpy(), np.repeat(trains[lo:hi], n), len(found.dictionary))
                held[chunk].append((found.dictionary, counts.astype(np.int64)))
        if size() >= 2 * MAX_WORDS:  # as batches have them: many are the same
            merge()
            if size() >= MAX_WORDS:
                yield from rows()
    yield from rows()
    free_memory()


def count_words(chunks: DataFrame) -> DataFrame:
    """(chunk, word, c, open, lead): the corpus-wide training count of each chunk's words, from
    one exchange by word; ``lead`` marks one row for each word. Written."""
    rows = chunks.select("chunk", "held_out", "text").mapInArrow(_count, "chunk int, word binary, n long, open int")
    over = "OVER (PARTITION BY word ORDER BY chunk {})"  # one order for both: the rows are sorted once
    return materialize(rows.selectExpr("chunk", "word", "open", f"sum(n) {over.format('ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING')} AS c",
                                       f"row_number() {over.format('')} = 1 AS lead"))


def numbered(vocab: DataFrame, min_count: int, top_words: int | None = None) -> tuple[DataFrame, int]:
    """``vocab`` with the number of each clustered word (``id``, from 2 on; null for others), and one
    more than the largest. Words are numbered in hash buckets of about equal size, so a few numbers
    are left without a word, and in hash order, so that first classes are dealt at random. Written."""
    lead = vocab.where(F.col("lead") & (F.col("c") >= max(1, min_count)))
    if top_words is not None:
        lead = lead.orderBy(F.desc("c"), "word").limit(top_words)
    buckets = max(1, min(1 << 16, lead.count() // 200))
    words = lead.select("word", F.pmod(F.xxhash64("word"), F.lit(buckets)).alias("b")) \
        .selectExpr("word", f"cast(1 + b + (row_number() OVER (PARTITION BY b ORDER BY xxhash64(word, 7), word) - 1) * {buckets} + 1 AS int) AS id")
    out = materialize(vocab.join(words.hint("shuffle_hash"), "word", "left"))  # the rows by chunk need no sort
    return out, 1 + (out.agg(F.max("id")).first()[0] or 1)


def _pack(i: np.ndarray, v: np.ndarray, n: np.ndarray) -> bytes:
    """Counted pairs (i, v), sorted by both, as compressed bytes: gaps of the different i, how many
    pairs each has, then v, then n (in 4 bytes if that is enough for all)."""
    at = run_bounds(i)
    width = "<i4" if not len(n) or n.max() < 1 << 31 else "<i8"
    raw = [np.array([len(at) - 1, len(i)], "<i8"), np.diff(i[at[:-1]], prepend=0).astype("<i4"), np.diff(at).astype("<i4"), v.astype("<i4"), n.astype(width)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in raw))


def _runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A pack's different i, how many pairs each has, and the v and n of all pairs."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    k, m = np.frombuffer(raw, "<i8", 2).tolist()
    at = 16 + 8 * k + 4 * m
    return (np.cumsum(np.frombuffer(raw, "<i4", k, 16), dtype=np.int64), np.frombuffer(raw, "<i4", k, 16 + 4 * k), np.frombuffer(raw, "<i4", m, 16 + 8 * k),
            np.frombuffer(raw, "<i4" if len(raw) == at + 4 * m else "<i8", m, at))


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, each, v, n = _runs(data)
    return np.repeat(i, each), v.astype(np.int64), n.astype(np.int64)


def _dealt(i: np.ndarray, v: np.ndarray, n: np.ndarray, parts: int):
    """(part, packed pairs) for the pairs of each part; words are dealt to parts by number."""
    key = i << 32 | v
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key)
        i, v, n = i[order], v[order], n[order]
    at = run_bounds(i)
    own, each = i[at[:-1]], np.diff(at)
    part = (own * 2_654_435_761 % 4_294_967_291) % parts
    by = np.argsort(part, kind="stable")  # words, not pairs, are sorted by part
    part, each = part[by], each[by]
    end = np.cumsum(each)
    order = np.repeat(at[:-1][by] - (end - each), each) + np.arange(len(i))
    i, v, n = i[order], v[order], n[order]
    bounds = run_bounds(part)
    to = np.concatenate([[0], end])[bounds]
    for p, lo, hi in zip(part[bounds[:-1]].tolist(), to[:-1].tolist(), to[1:].tolist(), strict=True):
        yield p, _pack(i[lo:hi], v[lo:hi], n[lo:hi])


def _added(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of several packs, sorted, equal ones added up."""
    keys, counts = [], []
    for i, each, v, n in map(_runs, packed):
        keys.append(np.repeat(i << 32, each) | v)
        counts.append(n)
    key, n = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    keys.clear()
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = run_bounds(key)[:-1]
    key = key[first]
    return key >> 32, key & 0xFFFFFFFF, np.add.reduceat(n, first) if len(first) else n


def _pairs(base: int, parts: int):
    """Counts of neighbouring ids (u, v) in a chunk's training texts, dealt by u and packed; open ids
    from ``base`` on."""
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        opened = words.column("open").to_numpy().astype(np.int64)
        own = words.column("id").fill_null(-1).to_numpy().astype(np.int64)
        ids, local = np.unique(np.concatenate([[END, START], np.where(own < 0, base + opened, own)]), return_inverse=True)
        size, codes, held = len(ids), [], 0
        got: list = []

        def settle():
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            codes.clear()
            got.extend(_dealt(ids[code // size], ids[code % size], n, parts))  # packed at once: few MB wait, not all pairs
        local = local.astype(np.int64)
        for found, n in places(texts.column("text"), words.column("word")):
            path, at = _paths(local[2:][found], n, int(local[1]), int(local[0]))
            lo = 0
            while lo < len(n):  # whole texts with about PAIR_TOKENS tokens
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PAIR_TOKENS - held, "right")) - 1)
                code = path[at[lo]:at[hi] - 1] * size + path[at[lo] + 1:at[hi]]
                codes.append(np.delete(code, at[lo + 1:hi] - at[lo] - 1))  # no pair leads from one text to the next
                held += int(at[hi] - at[lo])
                if held >= PAIR_TOKENS or hi < len(n):
                    settle()
                    held = 0
                lo = hi
        if codes:
            settle()
        free_memory()
        return pa.table({"part": pa.array([p for p, _ in got], pa.int32()), "after": pa.array([d for _, d in got], pa.binary())})
    return run


def _merge_after(parts: int):
    """Packs of a part -> its pairs added up, and the same pairs turned round for the parts of v."""
    def run(it):
        held: dict[int, list[bytes]] = defaultdict(list)
        for b in it:
            for p, d in zip(b.column("part").to_pylist(), b.column("after").to_pylist(), strict=True):
                held[p].append(d)
        for p in sorted(held):
            u, v, n = _added(held.pop(p))
            rows = [(p, _pack(u, v, n), None), *((q, None, d) for q, d in _dealt(v, u, n, parts))]
            q, after, before = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(after, pa.binary()), pa.array(before, pa.binary())],
                                             names=["part", "after", "before"])
        free_memory()
    return run


def _merge_both(it):
    """A part's pairs both ways: after (u before v: u, v, n) and before (v, u, n)."""
    held: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    for b in it:
        for p, *data in zip(*(b.column(c).to_pylist() for c in ("part", "after", "before")), strict=True):
            for kept, d in zip(held[p], data, strict=True):
                if d is not None:
                    kept.append(d)
    for p in sorted(held):
        cols = [pa.array([_pack(*_added(x)) if x else _pack(*[np.zeros(0, np.int64)] * 3)], pa.binary()) for x in held.pop(p)]
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), *cols], names=["part", "after", "before"])
    free_memory()


def neighbours(chunks: DataFrame, vocab: DataFrame, base: int) -> DataFrame:
    """(part, after, before): for the words of a part, their counted neighbours on either side, packed.
    Written once; a round reads it as bytes and shuffles nothing of it."""
    parts = max(1, parts_for(chunks, 4 << 20))
    run = _pairs(base, parts)
    found = chunks.where(~F.col("held_out")).select("chunk", "text").groupBy("chunk") \
        .cogroup(vocab.select("chunk", "word", "open", "id").groupBy("chunk")).applyInArrow(lambda left, right: run(left, right), "part int, after binary")
    ddl = "part int, after binary, before binary"
    once = materialize(found.repartition(parts, "part").mapInArrow(_merge_after(parts), ddl))
    out = materialize(once.repartition(parts, "part").mapInArrow(_merge_both, ddl))
    discard(once)
    return out


def _matrix(cls: np.ndarray, nc: int):
    def run(it):
        m = np.zeros(nc * nc)
        for b in it:
            for data in b.column(0).to_pylist():
                u, each, v, n = _runs(data)
                m += np.bincount(np.repeat(cls[u].astype(np.int64) * nc, each) + cls[v], n, minlength=nc * nc)
        at = np.flatnonzero(m)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(m[at].astype(np.int64))], names=["cell", "n"])
    return run


def class_matrix(near: DataFrame, cls: np.ndarray, nc: int) -> np.ndarray:
    rows = near.select("after").mapInArrow(_matrix(cls, nc), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # nc^2 rows
    m = np.zeros(nc * nc)
    m[rows["cell"]] = rows["n"]
    return m.reshape(nc, nc)


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(m: np.ndarray) -> float:
    return float(_xlogx(m).sum() - _xlogx(m.sum(1)).sum() - _xlogx(m.sum(0)).sum())


def move_gains(m: np.ndarray, a: int, out: np.ndarray, into: np.ndarray, same: float, first: int) -> np.ndarray:
    """Likelihood of a word of class ``a`` placed in each class from ``first`` on, less that of
    the word taken out. ``out`` and ``into``: its counts with the classes after and before it,
    other words only; ``same``: how often it follows itself."""
    c = m.copy()
    c[a, :] -= out
    c[:, a] -= into
    c[a, a] -= same
    rows, cols = c.sum(1) + into, c.sum(0) + out  # other words' own, wherever this word goes
    to = np.arange(first, len(m))
    r, k = c[to, :], c[:, to].T
    diag = c[to, to]
    gain = (_xlogx(r + out) - _xlogx(r)).sum(1) + (_xlogx(k + into) - _xlogx(k)).sum(1)
    gain -= _xlogx(diag + out[to]) - _xlogx(diag) + _xlogx(diag + into[to]) - _xlogx(diag)
    gain += _xlogx(diag + out[to] + into[to] + same) - _xlogx(diag)
    ro, ci = out.sum() + same, into.sum() + same
    return gain - (_xlogx(rows[to] + ro) - _xlogx(rows[to])) - (_xlogx(cols[to] + ci) - _xlogx(cols[to]))


def shortlist(m: np.ndarray, a: np.ndarray, out: np.ndarray, into: np.ndarray, first: int, size: int) -> np.ndarray:
    """For each word its own class ``a`` and the ``size`` - 1 others of largest first-order change in
    likelihood (the word's counts times the log ratios of the class pairs)."""
    soft = m + 0.1
    ratio = np.log(soft) - np.log(soft.sum(1, keepdims=True)) - np.log(soft.sum(0, keepdims=True))
    near = out @ ratio[first:].T + into @ ratio[:, first:]
    near[np.arange(len(a)), a - first] = np.inf
    size = min(size, near.shape[1])
    return first + np.argpartition(-near, size - 1, axis=1)[:, :size]


def small_steps(m: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For the matrix and its transpose: what x more, for x up to ``SMALL``, add to x log x of each cell,
    and the same for cells that held these x. Far fewer logarithms than the words have counts."""
    x = np.arange(1.0, SMALL + 1)[:, None]
    out = []
    for c in (m, m.T):
        cells = c.ravel()
        less = np.maximum(cells - x, 0)
        out.append(((_xlogx(cells + x) - _xlogx(cells)).ravel(), (_xlogx(less + x) - _xlogx(less)).ravel()))
    return out


def gains_of(m: np.ndarray, a: np.ndarray, out: np.ndarray, into: np.ndarray, same: np.ndarray, to: np.ndarray,
             steps: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """``move_gains`` of many words at once (a row each), for the classes ``to`` of each word, at the cost
    of their nonzero counts. ``steps``: ``small_steps(m)``."""
    row, nc = np.arange(len(a))[:, None], len(m)
    own = to == a[:, None]
    stays, column = own.any(1), own.argmax(1)
    gain = np.zeros(to.shape)
    for c, mine, other, (step, back) in zip((m, m.T), (out, into), (into, out), steps or small_steps(m), strict=True):
        at = np.flatnonzero(mine)
        for lo in range(0, len(at), 200_000):
            w, k = np.divmod(at[lo:lo + 200_000], nc)
            x, t = mine[w, k], to[w]
            cell = ((np.minimum(x, SMALL).astype(np.int64) - 1) * nc * nc + k)[:, None] + t * nc
            more = step.take(cell)
            f = np.flatnonzero(stays[w])
            g = column[w[f]]
            more[f, g] = back.take(cell[f, g])  # the word leaves the cells of its own class
            e = np.flatnonzero((x > SMALL) | (k == a[w]))
            we, ke, xe, te = w[e], k[e], x[e][:, None], t[e]
            base = c[te, ke[:, None]]
            base -= np.where((ke == a[we])[:, None], other[we[:, None], te] + own[we] * same[we][:, None], 0) + own[we] * xe
            np.maximum(base, 0, out=base)
            more[e] = _xlogx(base + xe) - _xlogx(base)
            start = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            gain[w[start]] += np.add.reduceat(more, start, axis=0)
    diag = m[to, to] - own * (out[row, to] + into[row, to] + same[:, None])
    np.maximum(diag, 0, out=diag)
    o, i = out[row, to], into[row, to]
    gain -= _xlogx(diag + o) - 2 * _xlogx(diag) + _xlogx(diag + i)
    gain += _xlogx(diag + o + i + same[:, None]) - _xlogx(diag)
    ro, ci = out.sum(1) + same, into.sum(1) + same
    rows, cols = m.sum(1)[to] - own * ro[:, None], m.sum(0)[to] - own * ci[:, None]
    return gain - (_xlogx(rows + ro[:, None]) - _xlogx(rows)) - (_xlogx(cols + ci[:, None]) - _xlogx(cols))


def _counts(i: np.ndarray, of: np.ndarray, v: np.ndarray, n: np.ndarray, words: np.ndarray, cls: np.ndarray, nc: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``words`` its counts with the classes of other words, and with itself. The pairs of
    i[k] are those from of[k] to of[k + 1]."""
    lo, hi = np.searchsorted(i, words[0]), np.searchsorted(i, words[-1], "right")
    mine, each = i[lo:hi], np.diff(of[lo:hi + 1])
    v, n = v[of[lo]:of[hi]], n[of[lo]:of[hi]].astype(np.float64)
    row = np.searchsorted(words, mine)
    own = np.flatnonzero(np.repeat(mine, each) == v)
    same = np.zeros(len(words))
    same[np.searchsorted(words, v[own])] = n[own]
    n[own] = 0
    full = np.bincount(np.repeat(row * nc, each) + cls[v], n, minlength=len(words) * nc).reshape(len(words), nc)
    return full, same


def _moves(cls: np.ndarray, m: np.ndarray, first: int, words: int):
    """The best class of each clustered word (ids from 2 to ``words`` - 1) that gains by a move, with
    the gain."""
    nc = len(m)

    def run(it):
        steps = small_steps(m)
        for b in it:
            for after, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x, y = ((i, np.concatenate([[0], np.cumsum(each)]), v, n) for i, each, v, n in (_runs(after), _runs(before)))
                ids = np.union1d(x[0], y[0])
                ids = ids[(ids >= 2) & (ids < words)]
                for lo in range(0, len(ids), 500):
                    w = ids[lo:lo + 500]
                    (out, same), (into, _) = _counts(*x, w, cls, nc), _counts(*y, w, cls, nc)
                    a = cls[w].astype(np.int64)
                    to = shortlist(m, a, out, into, first, SHORTLIST)
                    gain = gains_of(m, a, out, into, same, to, steps)
                    best = gain.argmax(1)
                    more = gain.max(1) - gain[to == a[:, None]]
                    on = more > 1e-6
                    yield pa.RecordBatch.from_arrays([pa.array(w[on]), pa.array(to[on, best[on]].astype(np.int32)), pa.array(more[on])],
                                                     names=["id", "best", "gain"])
        free_memory()
    return run


def exchange(near: DataFrame, words: int, classes: int, rounds: int | None = None, tol: float = 1e-3,
             heads: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all ids and the class matrix. Ids from 2 to ``words`` - 1 are clustered, in
    classes from 2 + OPEN on; open ids keep their class. ``heads`` (the most frequent words) start in a
    class each, so that the first round has contexts that mean something. Without ``rounds`` the
    search goes on until a round gains less than ``tol`` a token, or no share of the moves helps any
    more."""
    nc, first = 2 + OPEN + classes, 2 + OPEN
    cls = np.concatenate([[END, START], first + np.arange(words - 2) % classes, 2 + np.arange(OPEN)]).astype(np.int16)
    for k, i in enumerate((heads or [])[:classes]):
        cls[i] = first + k
    m = class_matrix(near, cls, nc)
    had, share, r = likelihood(m), 1.0, 0
    least = 1 / max(1, words)
    while words > 2 and (rounds is None or r < rounds):
        got = near.select("after", "before").mapInArrow(_moves(cls, m, first, words), "id long, best int, gain double").toPandas()  # numbers only, of words that gain
        ids, best = got["id"].to_numpy(), got["best"].to_numpy()
        if got["gain"].sum() < tol * m.sum():
            break
        gain = 0.0
        while gain <= 0 and share >= least:
            draw = (ids * 2_654_435_761 + (r + 1) * 2_246_822_519) % 4_294_967_291 / 4_294_967_291
            go = draw < share
            new = cls.copy()
            new[ids[go]] = best[go]
            m2 = class_matrix(near, new, nc)
            gain = likelihood(m2) - had
            if gain <= 0:
                share /= 2
        if gain <= 0:
            break
        cls, m, had, r = new, m2, had + gain, r + 1
        if gain / share < tol * m.sum():
            break
        share = min(share * 2, 0.5)
    return cls, m


class Model:
    """Class transitions and emissions (log10), sent with the tasks: class matrices and the class of
    each numbered word. ``ids`` and ``counts`` may give words of its own (id 2 on)."""

    def __init__(self, ids: dict[bytes, int], cls: np.ndarray, m: np.ndarray, counts: np.ndarray, open_n: np.ndarray,
                 open_v: np.ndarray, tokens: int, types: int, end_count: int, smooth: float = 1.0):
        nc = len(m)
        to = m.sum(0) + 1.0
        to[START] = 0.0
        share = to / to.sum()
        self.log_step = np.log10(np.maximum((m + smooth * share) / (m.sum(1, keepdims=True) + smooth), 1e-300))
        self.ids, self.cls, self.tokens, self.types, self.end_count = ids, cls, tokens, types, end_count
        self.open_room = open_n + open_v + 1.0
        self.class_n = m.sum(0)  # each training token follows something, so these are the classes' tokens
        total = np.zeros(nc)
        np.add.at(total, cls[2:2 + len(counts)], counts)
        self.log_word = np.log10(counts / total[cls[2:2 + len(counts)]]) if len(counts) else np.zeros(0)

    def table(self, counts: np.ndarray, opened: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and log10 emission of each word; ``number`` is -1 for words that are not clustered."""
        cls = 2 + opened.astype(np.int64)
        emit = np.log10((counts + 1.0) / self.open_room[opened])
        on = number >= 0
        cls[on] = self.cls[number[on]]
        emit[on] = np.log10(counts[on] / self.class_n[cls[on]])
        return cls, emit


def train(chunks: DataFrame, vocab: DataFrame, base: int, classes: int = 64, rounds: int | None = None, tol: float = 1e-3) -> Model:
    """``vocab`` with numbers below ``base`` (``numbered``)."""
    ends = chunks.where(~F.col("held_out")).count()
    lead = vocab.where("lead AND c > 0")
    sums = lead.groupBy("open").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.expr("if(id IS NULL, c, 0)")).alias("open_n"),
                                    F.sum(F.expr("if(id IS NULL, 1, 0)")).alias("open_v")).toPandas()  # OPEN rows
    open_n, open_v = np.zeros(OPEN), np.zeros(OPEN)
    open_n[sums["open"]], open_v[sums["open"]] = sums["open_n"], sums["open_v"]
    tokens, types = int(sums["n"].sum()) + ends, int(sums["v"].sum()) + (ends > 0)
    heads = [r["id"] for r in lead.where("id IS NOT NULL").orderBy(F.desc("c"), "word").limit(classes).select("id").collect()]
    near = neighbours(chunks, vocab, base)
    cls, m = exchange(near, base, classes, rounds, tol, heads)
    discard(near)
    return Model({}, cls, m, np.zeros(0), open_n, open_v, tokens, types, ends)


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                  ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_OUT_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(model: Model):
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        counts, opened = words.column("c").to_numpy(), words.column("open").to_numpy()
        cls, emit = model.table(counts, opened, words.column("id").fill_null(-1).to_numpy())
        room = model.tokens + model.types + 1.0
        base, known = np.log10((counts + 1.0) / room), counts > 0
        end_base, end_known = np.log10((model.end_count + 1.0) / room), int(model.end_count > 0)
        cols: list[list] = [[] for _ in range(4)]
        for i, per in places(texts.column("text"), words.column("word")):
            path, at = _paths(cls[i], per, START, END)
            steps, own_base, own_known, own_emit = model.log_step[path[:-1], path[1:]], base[i], known[i], emit[i]
            for k, (p, q) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                x, y = p - 2 * k, q - 2 * k - 2  # the text's own words
                for c, v in zip(cols, (y - x + 1, int(own_known[x:y].sum()) + end_known, float(own_base[x:y].sum() + end_base),
                                       float(steps[p:q - 1].sum() + own_emit[x:y].sum())), strict=True):
                    c.append(v)
        free_memory()
        n = texts.num_rows
        return pa.Table.from_arrays([texts.column("doc_id"), texts.column("held_out"), pa.array(cols[0], pa.int64()),
                                     pa.array(cols[1], pa.int64()), pa.array(np.full(n, model.tokens, np.int64)),
                                     pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())], schema=_OUT)
    return run


def score_texts(docs: DataFrame, held_out, top_words: int | None = None, classes: int = 64, rounds: int | None = None,
                id_col: str = "doc_id", text_col: str = "text", min_count: int = 10, tol: float = 1e-3) -> DataFrame:
    """Train on the rows for which ``held_out`` (a function from an id column's name to a boolean
    column) is false, and score all rows: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams), score, perplexity (of the class model, by token). Words seen
    ``min_count`` times are clustered until a round gains less than ``tol``; ``top_words`` and
    ``rounds`` bound that only if given."""
    chunks = chunked(reuse_input(docs), id_col, text_col, held_out)
    counted = count_words(chunks)
    vocab, base = numbered(counted, min_count, top_words)
    discard(counted)
    model = train(chunks, vocab, base, classes, rounds, tol)
    run = _score(model)
    out = chunks.groupBy("chunk").cogroup(vocab.select("chunk", "word", "c", "open", "id").groupBy("chunk")).applyInArrow(
        lambda left, right: run(left, right), _OUT_DDL)
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
