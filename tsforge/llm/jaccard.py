"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact intersection.

Each text becomes its sorted set of 64-bit shingle hashes. Texts with the same set are one class.
Two classes with Jaccard >= t share at least m shingles among the first n - ceil(t n) + m of each set,
in any one order of all shingles; so only classes that meet at m such shingles need comparing, and m
grows with the set (one for each ``PER_MEETING`` shingles), as long texts meet by chance. The order puts
very common shingles (found on a sample of documents; a wrong guess costs time, never a link) last.

Classes that meet at a shingle are sorted by set size and cut into tiles. A tile compares only sizes
within t of each other, first by parity bitmaps: each set flips one bit for each shingle, so the bits
in which two bitmaps differ are at most the symmetric difference, which bounds the overlap from
above. What remains is decided by intersecting the sorted arrays.

Links only matter through what they connect, so no pair table of a group is ever written. Candidates
become the edges of groups: round one compares members of a tile with a few pivots; round two looks at
the tiles that still hold two components. Few members: their pairs are counted over tiles, and those that
meet often enough and pass the bitmaps are edges. Many members: the task that holds the tile keeps only as
many edges as hold together what the bitmaps allow. The sets of a group are then brought together once,
in tiles of size bands, and the task that holds them intersects sorted arrays and returns a forest of
links: at most one link fewer than the tile has members.

Cases: a text with fewer words than a shingle is one shingle; null and empty texts have an empty set
and link with nothing; a null id gets results but never names a component of known ids; rows that
repeat an id or a text are members like others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import batches, discard, free_memory, input_bytes, materialize, run_bounds
from .components import components

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling combination
HOT_KEYS = 1 << 17     # most common shingles kept on the driver for the order
HOT_SAMPLE = 32        # one document in so many is looked at for them
TILE = 1024            # most members of a tile
PIVOTS = 4
PER_MEETING = 40
SMALL = 8              # members of a tile whose pairs are counted one by one
GROUP = 128            # least members of a tile of a group of candidates
SHINGLES = 1 << 21     # most shingles of such a tile, on average
BROADCAST_ROWS = 1 << 20  # rows of (id) or (class, component) sent to every executor at most
_SEEN = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles (ASCII letters in lower case)."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    m = min(n, k)
    h = np.full(n - m + 1, m, np.uint64)
    for i in range(m):
        h = h * _STEP + w[i:n - m + 1 + i]
    return np.unique(_mix(h))


def bitmap(s: np.ndarray, per: int = 4) -> np.ndarray:
    """Parity bits of a set, ``per`` to twice as many for each shingle (a power of two, 64 to 2^19). With
    four, few enough share a bit that the bound is close to the true overlap; one (a sketch) still tells
    unrelated sets apart: half its bits differ, and a link allows a seventh of both sizes."""
    width = min(1 << 19, max(64, 1 << (per * len(s) - 1).bit_length()))
    odd = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _meetings(n):
    """Prefix shingles that a set of ``n`` must share with any partner (n may be an array)."""
    return 1 + n // PER_MEETING


def _prefix_size(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + _meetings(n)  # n - ceil(percent n / 100) + meetings


def _sign(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a, np.uint64).view(np.int64)


def _class_name(turn: int):
    """The class of a set given as bytes: its hash, or (for ``turn`` above 0) that hash and a second one
    turned by so many bits, by exclusive or."""
    def name(raw: bytes) -> int:
        c, d = xxh3_64_intdigest(raw) ^ (1 << 63), xxh3_64_intdigest(raw, seed=1) ^ (1 << 63)
        c ^= ((d << turn | d >> (64 - turn)) & ((1 << 64) - 1)) if turn else 0
        return c - (1 << 64) if c >> 63 else c
    return name


def _renamed(turn: int):
    """``_class_name`` of the columns cls and cls2."""
    turned = F.shiftleft("cls2", turn).bitwiseOR(F.shiftrightunsigned("cls2", 64 - turn))
    return F.col("cls").bitwiseXOR(turned) if turn else F.col("cls")


def _common_shingles(src: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, estimated documents) of common shingles, sorted by shingle."""
    def count(it):
        for b in it:
            sets = [shingles(t, k) for t in batches(b.column(1))]
            if sets:
                v, c = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(_sign(v)), pa.array(c.astype(np.int64))], names=["s", "c"])

    some = src.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(HOT_SAMPLE)) == 0)
    top = some.mapInArrow(count, "s long, c long").groupBy("s").agg(F.sum("c").alias("c")).where("c >= 8") \
        .orderBy(F.desc("c"), "s").limit(HOT_KEYS).toPandas()
    s, c = top["s"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64) * HOT_SAMPLE
    order = np.argsort(s)
    return s[order], c[order]


def _signatures(k: int, percent: int, hot: np.ndarray, hot_count: np.ndarray):
    """Each row's class, size, and (once for each class and task) bitmap and prefix."""
    def run(it):
        seen: set = set()
        for b in it:
            out: list[list] = [[] for _ in range(8)]
            for doc, text in zip(b.column("doc_id").to_pylist(), batches(b.column("text")), strict=True):
                s = shingles(text, k)
                raw = s.tobytes()
                c1, c2 = xxh3_64_intdigest(raw) - (1 << 63), xxh3_64_intdigest(raw, seed=1) - (1 << 63)
                bits = sketch = prefix = None
                n_hot = 0
                if len(s) and (c1, c2) not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add((c1, c2))
                    bits, sketch = bitmap(s).tobytes(), bitmap(s, 1).tobytes()
                    p = _prefix_size(len(s), percent)
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                        is_hot = hot[at] == s
                        cold, h = s[~is_hot], np.flatnonzero(is_hot)
                        h = h[np.lexsort((s[h], hot_count[at[h]]))]
                        prefix = np.concatenate([cold, s[h]])[:p]
                        n_hot = max(0, p - len(cold))
                    else:
                        prefix = s[:p]
                    prefix = _sign(prefix)
                for c, v in zip(out, (doc, len(s), c1, c2, bits, sketch, prefix, n_hot), strict=True):
                    c.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int32()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(out, types, strict=True)), b.column("tag")],
                                             names=["doc_id", "n", "cls", "cls2", "bits", "sketch", "prefix", "n_hot", "tag"])
        free_memory()
    return run


def _tiles(it):
    """Rows (key, salt, n, cls) sorted so -> tiles of at least two classes: one row for each."""
    def emit(key, salt, n, cls, out):
        _, first = np.unique(cls, return_index=True)
        keep = np.sort(first)
        n, cls = n[keep], cls[keep]
        parts = -(-len(n) // TILE)
        for i in range(parts):
            if len(n) > 1 or salt >= 0:
                out.append((key, (max(salt, 0) << 32) + i, parts > 1 or salt >= 0, n[i * TILE:(i + 1) * TILE], cls[i * TILE:(i + 1) * TILE]))

    def pack(out):
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                                          names=["key", "tile", "multi", "ns", "cs"])

    held: list = []  # rows of the run that the last batch broke off, in whole batches
    for b in it:
        cols = [b.column(i).to_numpy() for i in range(4)]
        if held:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
        key, salt, n, cls = cols
        if not len(key):
            continue
        change = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1])) + 1])
        last = int(change[-1])
        ends = change[1:]
        many = np.flatnonzero((ends - change[:-1] > 1) | (salt[change[:-1]] >= 0))
        out: list = []
        for q in many.tolist():
            s, e = int(change[q]), int(ends[q])
            emit(int(key[s]), int(salt[s]), n[s:e], cls[s:e], out)
        held = [c[last:] for c in cols]
        if out:
            yield pack(out)
    out = []
    if held and len(held[0]):
        emit(int(held[0][0]), int(held[1][0]), held[2], held[3], out)
    yield pack(out)


def _pivot_pairs(percent: int):
    """Round one: members of a tile against its pivots (all pairs of small tiles), and the pivots
    themselves for keys with several tiles (as rows with no partner)."""
    def rows(a, b, lone_k, lone_c):
        a, b = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (a, b))
        k = len(lone_c)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, np.array(lone_c, np.int64)])), pa.concat_arrays([pa.array(b), pa.nulls(k, pa.int64())]),
             pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(lone_k, pa.int64())])], names=["a", "b", "key"])

    def run(it):
        a, b, lone_k, lone_c, held = [], [], [], [], 0
        for x in it:
            for key, multi, ns, cs in zip(x.column("key").to_pylist(), x.column("multi").to_pylist(), x.column("ns"), x.column("cs"), strict=True):
                n, c = ns.values.to_numpy(), cs.values.to_numpy()
                m = len(n)
                low = np.argsort(c)[:m if m <= 16 else PIVOTS]
                i, j = np.repeat(low, m), np.tile(np.arange(m), len(low))
                ok = (c[i] < c[j]) & (100 * np.minimum(n[i], n[j]).astype(np.int64) >= percent * np.maximum(n[i], n[j]).astype(np.int64))
                a.append(c[i[ok]])
                b.append(c[j[ok]])
                held += len(a[-1])
                if multi:
                    lone_k += [key] * min(PIVOTS, m)
                    lone_c += np.sort(c)[:PIVOTS].tolist()
                if held > _FLUSH:
                    yield rows(a, b, lone_k, lone_c)
                    a, b, lone_k, lone_c, held = [], [], [], [], 0
        yield rows(a, b, lone_k, lone_c)
    return run


def _fold(m: np.ndarray, words: int) -> np.ndarray:
    while m.shape[1] > words:
        h = m.shape[1] // 2
        m = m[:, :h] ^ m[:, h:]
    return m


def _differ(bits: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the bitmaps of pairs differ, at the narrower one's width."""
    size = np.array([len(x) // 8 for x in bits], np.int64)
    out = np.zeros(len(i), np.int64)
    row = np.zeros(len(bits), np.int64)
    by = {}
    for w in np.unique(size):
        at = np.flatnonzero(size == w)
        row[at] = np.arange(len(at))
        by[int(w)] = np.frombuffer(b"".join(bits[q] for q in at), np.uint64).reshape(len(at), w)
    code = size[i] * (1 << 20) + size[j]
    for c in np.unique(code):
        q = np.flatnonzero(code == c)
        wi, wj = int(c) >> 20, int(c) & ((1 << 20) - 1)
        w = min(wi, wj)
        mi, mj = _fold(by[wi], w), _fold(by[wj], w)
        step = max(1, (1 << 21) // w)
        for lo in range(0, len(q), step):
            z = q[lo:lo + step]
            out[z] = np.bitwise_count(mi[row[i[z]]] ^ mj[row[j[z]]]).sum(1, dtype=np.int64)
    return out


def _may_link(n_i, n_j, differ, percent: int) -> np.ndarray:
    """False where even a symmetric difference of only ``differ`` leaves Jaccard under t."""
    total = n_i.astype(np.int64) + n_j.astype(np.int64)
    return 100 * (total - differ) >= percent * (total + differ)


def _bound_pairs(percent: int):
    def run(it):
        for b in it:
            a, c = b.column("a"), b.column("b")
            bits = b.column("bits_a").to_pylist() + b.column("bits_b").to_pylist()
            m = b.num_rows
            i, j = np.arange(m), np.arange(m, 2 * m)
            ok = _may_link(b.column("n_a").to_numpy(), b.column("n_b").to_numpy(), _differ(bits, i, j), percent) if m else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok)), c.filter(pa.array(ok))], names=["a", "b"])
    return run


def _forest(n, p, label: list[int], split: int, percent: int, bits: list, linked=None) -> list[tuple[int, int]]:
    """Pairs (i, j) of members that join different labels, at most one fewer than members: pairs of
    different components ``p`` with fitting sizes and bitmaps, that hold by ``linked`` if given.
    In one tile, or between its first ``split`` members and the others. ``label`` is updated."""
    out, m, lo, width = [], split or len(n), 0, 1
    while lo < m:  # a few members against the rest first, so that groups of copies join early
        now = np.array(label)
        left, right = np.arange(lo, min(lo + width, m)), np.arange(split or lo, len(n))
        i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        ok = (now[i] != now[j]) & (p[i] != p[j]) & (i < j)
        i, j = i[ok], j[ok]
        ok = 100 * np.minimum(n[i], n[j]).astype(np.int64) >= percent * np.maximum(n[i], n[j]).astype(np.int64)
        i, j = i[ok], j[ok]
        if len(i):
            ok = _may_link(n[i], n[j], _differ(bits, i, j), percent)
            for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                a, b = label[x], label[y]
                if a != b and (linked is None or linked(x, y)):
                    out.append((x, y))
                    label[:] = [a if v == b else v for v in label]
        lo, width = lo + width, min(64, 2 * width)
    return out


def _edges(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])


def _meetings_of_small_tiles(percent: int):
    """Rows (key, w, n, cls, comp) of tiles of at most SMALL members, a key's rows together -> pairs
    of different components that meet in it: (a, b, times, needed meetings)."""
    def pairs(w, n, c, p):
        i, j = np.triu_indices(len(n), 1)
        small, big = np.minimum(n[i], n[j]).astype(np.int64), np.maximum(n[i], n[j]).astype(np.int64)
        ok = (p[i] != p[j]) & (100 * small >= percent * big)
        i, j = i[ok], j[ok]
        return np.stack([np.minimum(c[i], c[j]), np.maximum(c[i], c[j]), w[i], _meetings(small[ok])], 1)

    def batch(got):
        u = np.concatenate([np.zeros((0, 4), np.int64), *got])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(u[:, k])) for k in range(4)], names=["a", "b", "w", "need"])

    def run(it):
        held, got = [], []
        for b in it:
            cols = [b.column(i).to_numpy() for i in range(5)]
            if held:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            at = run_bounds(cols[0])
            for s, e in zip(at[:-2].tolist(), at[1:-1].tolist(), strict=True):
                if (cols[4][s:e] != cols[4][s]).any():
                    got.append(pairs(*(x[s:e] for x in cols[1:])))
            held = [x[at[-2]:] for x in cols]
            if sum(map(len, got)) > _FLUSH:
                yield batch(got)
                got = []
        if held:
            got.append(pairs(*held[1:]))
        yield batch(got)
    return run


_FLUSH = 100_000  # pairs that a task holds before it passes them on


def _may_link_forest(percent: int, two: bool):
    """Large tiles, or two of one key: edges between members that the bitmaps do not rule out, only as
    many as hold them together. Members are structs (n, cls, comp, sketch)."""
    def run(it):
        for b in it:
            a, c = [], []
            for r in range(b.num_rows):
                tiles = [b.column(m)[r].values for m in (("m1", "m2") if two else ("m1",))]
                n, cls, p = (np.concatenate([t.field(f).to_numpy() for t in tiles]) for f in ("n", "cls", "comp"))
                bits = [x for t in tiles for x in t.field("sketch").to_pylist()]
                for x, y in _forest(n, p, list(range(len(n))), len(tiles[0]) if two else 0, percent, bits):
                    a.append(cls[x])
                    c.append(cls[y])
            yield _edges(a, c)
    return run


def _sets_of(k: int, named):
    """Rows (text, cls, ...) -> (..., set) where the text is of that class: an id may stand for
    several texts."""
    def run(it):
        for b in it:
            sets = [shingles(t, k).tobytes() for t in batches(b.column(0))]
            own = pa.array([named(x) == c for x, c in zip(sets, b.column(1).to_pylist(), strict=True)], pa.bool_())
            cols = [*b.columns[1:], pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.filter(own) for c in cols], names=[*b.schema.names[1:], "set"])
    return run


def _link_forest(percent: int):
    """One or two tiles of a group (side, cls, comp, set): links that join different components, by
    bitmaps and then by intersecting the sorted arrays."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("side", "ascending"), ("cls", "ascending")])
        one = np.concatenate([[True], t.column("cls").to_numpy()[1:] != t.column("cls").to_numpy()[:-1]])
        t = t.filter(pa.array(one))  # rows that repeat an id and a text
        side, cls, p = (t.column(c).to_numpy() for c in ("side", "cls", "comp"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("set")]
        n = np.array([len(x) for x in sets], np.int64)

        def linked(x, y):
            s, o = (sets[x], sets[y]) if n[x] <= n[y] else (sets[y], sets[x])
            at = np.minimum(np.searchsorted(o, s), len(o) - 1)
            both = int(np.count_nonzero(o[at] == s))
            return 100 * both >= percent * (len(s) + len(o) - both)
        label = np.unique(p, return_inverse=True)[1].tolist()
        bits = [bitmap(x).tobytes() for x in sets]
        got = _forest(n, p, label, int(np.count_nonzero(side == 0)) if side.any() else 0, percent, bits, linked)
        return pa.Table.from_batches([_edges([cls[x] for x, _ in got], [cls[y] for _, y in got])])
    return run


def _small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast only if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class JaccardJoin:
    """The join of one table; ``result`` runs it."""

    def __init__(self, docs: DataFrame, percent: int = 75, k: int = 5, id_col: str = "doc_id", text_col: str = "text",
                 tag_col: str | None = None):
        tag = F.lit(None) if tag_col is None else F.col(tag_col)
        self.src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), tag.cast("string").alias("tag"))
        self.percent, self.k = percent, k
        self.parts = max(1, math.ceil(2 * input_bytes(docs) / (32 << 20)))

    def _settle(self, edges: DataFrame, comp: DataFrame | None) -> DataFrame:
        """Links among the groups that ``edges`` (a, b) hold together, written; as many as connect what
        links connect. Every pair of different components of a group is looked at, and each set is
        brought to its group once. A group of many sets is cut into tiles by bands of sizes, each so
        wide that links stay in a band or join neighbouring ones, and tiles meet in pairs."""
        group = components(edges)
        m = group.select(F.col("node").alias("cls"), F.col("label").alias("g")).join(self.reps.select("cls", "n", "doc_id"), "cls")
        if comp is not None:
            m = m.join(comp.select(F.col("node").alias("cls"), F.col("label").alias("comp")), "cls", "left")
        m = materialize(m.withColumn("comp", F.col("cls") if comp is None else F.coalesce("comp", "cls")))
        size = F.count(F.lit(1))
        wide = m.groupBy("g").agg(size.alias("members"), F.sum("n").alias("shingles")).where(f"members > {GROUP} OR shingles > {SHINGLES}").select("g")
        wide = materialize(wide)
        base = math.log(100 / self.percent) * (1 + 1e-9)  # sizes at the very border stay in neighbouring bands
        band = F.floor(F.log(F.col("n").cast("double")) / base).cast("int")
        big = m.join(wide, "g").withColumn("band", band)
        cuts = materialize(big.groupBy("g", "band").agg(F.greatest(
            F.ceil(size / F.greatest(F.lit(GROUP), 4 * F.sqrt(size))), F.ceil(F.sum("n") / SHINGLES)).cast("int").alias("cuts")))
        tiles = cuts.select("g", "band", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
        x, y = (tiles.select("g", F.col("band").alias(f"b{k}"), F.col("cut").alias(f"c{k}")) for k in (1, 2))
        two = x.join(y, "g").where("(b2 = b1 AND c2 >= c1) OR b2 = b1 + 1")
        sides = two.selectExpr("g", "b1 AS band", "c1 AS cut", "struct(b1, c1, b2, c2, 0 AS side) AS job").unionByName(
            two.where("b1 <> b2 OR c1 <> c2").selectExpr("g", "b2 AS band", "c2 AS cut", "struct(b1, c1, b2, c2, 1 AS side) AS job"))
        jobs = sides.groupBy("g", "band", "cut").agg(F.collect_list("job").alias("jobs"))  # a tile's pairs of tiles
        many = big.join(cuts, ["g", "band"]).withColumn("cut", F.pmod("cls", "cuts").cast("int")).join(jobs, ["g", "band", "cut"])
        cols = ["doc_id", "cls", "g", "comp", "jobs"]
        alone = F.expr("array(struct(0 AS b1, 0 AS c1, 0 AS b2, 0 AS c2, 0 AS side))")
        need = materialize(m.join(wide, "g", "left_anti").withColumn("jobs", alone).select(*cols).unionByName(many.select(*cols)))
        texts = self.src.withColumnRenamed("doc_id", "id").join(_small(need), F.col("id").eqNullSafe(F.col("doc_id"))).select("text", "cls", "g", "comp", "jobs")
        job = "struct<b1:int,c1:int,b2:int,c2:int,side:int>"
        sets = texts.mapInArrow(_sets_of(self.k, self.named), f"cls long, g long, comp long, jobs array<{job}>, set binary") \
            .select("cls", "g", "comp", F.explode("jobs").alias("job"), "set").select("cls", "g", "comp", "job.*", "set")
        run = _link_forest(self.percent)
        out = materialize(sets.groupBy("g", "b1", "c1", "b2", "c2").applyInArrow(lambda t: run(t), "a long, b long"))
        discard(group, m, wide, cuts, need)
        return out

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the bitmaps do not rule out."""
        one = self.reps.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
        two = self.reps.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b") \
            .mapInArrow(_bound_pairs(self.percent), "a long, b long")

    @staticmethod
    def _members(tiles: DataFrame, comp: DataFrame) -> DataFrame:
        """A row for each member of the tiles, with its component (its own class if it has none)."""
        keep = [c for c in tiles.columns if c not in ("ns", "cs")]
        rows = tiles.select(*keep, F.posexplode(F.arrays_zip("ns", "cs")).alias("i", "x")).select(
            *keep, "i", F.col("x.ns").alias("n"), F.col("x.cs").alias("cls"))
        return rows.join(comp, F.col("cls") == F.col("node"), "left").select(*keep, "i", "n", "cls", F.coalesce("label", "cls").alias("comp"))

    def _met_in_small(self, tiles: DataFrame, comp: DataFrame) -> DataFrame:
        """Pairs of different components that meet often enough in tiles of few members. A tile's
        rows lie together and stay so if the components come by broadcast; else they are brought
        together again."""
        small = comp.count() <= BROADCAST_ROWS
        rows = self._members(tiles, F.broadcast(comp) if small else comp)
        if not small:
            rows = rows.repartition(self.parts, "key").sortWithinPartitions("key", "i")
        met = rows.select("key", "w", "n", "cls", "comp").mapInArrow(_meetings_of_small_tiles(self.percent), "a long, b long, w long, need long")
        return met.groupBy("a", "b").agg(F.sum("w").alias("met"), F.max("need").alias("need")).where("met >= need").select("a", "b")

    def _held_by_large(self, tiles: DataFrame, comp: DataFrame) -> DataFrame:
        """Edges that hold together what may link in tiles of many members: tiles of one component are
        dropped, the others are compared in themselves and, where a shingle has several, with those
        whose sizes overlap."""
        pct = self.percent
        rows = materialize(self._members(tiles, comp))
        mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        left = rows.join(mixed, "key").join(self.reps.select("cls", "sketch"), "cls")
        grouped = materialize(left.groupBy("key", "tile").agg(
            F.min("n").alias("n0"), F.max("n").alias("n1"), F.collect_list(F.struct("n", "cls", "comp", "sketch")).alias("m1")))
        others = grouped.select("key", F.col("tile").alias("tile2"), F.col("n0").alias("n02"), F.col("n1").alias("n12"), F.col("m1").alias("m2"))
        across = grouped.join(others, "key").where(f"tile < tile2 AND 100 * n1 >= {pct} * n02 AND 100 * n12 >= {pct} * n0").select("m1", "m2")
        self.spare = [rows, grouped]
        ddl = "a long, b long"
        return grouped.select("m1").mapInArrow(_may_link_forest(pct, False), ddl).union(across.mapInArrow(_may_link_forest(pct, True), ddl))

    def run(self) -> DataFrame:
        """(doc_id, n_shingles, component_id, label, tag): the row's set size, the smallest id in its
        component, the component's own name (null for an empty set), and the row's tag."""
        pct = self.percent
        hot, hot_count = _common_shingles(self.src, self.k)
        salts = max(1, math.ceil(int(hot_count.max()) / (4 * TILE))) if len(hot) else 1
        written = materialize(self.src.mapInArrow(
            _signatures(self.k, pct, hot, hot_count),
            "doc_id long, n int, cls long, cls2 long, bits binary, sketch binary, prefix array<long>, n_hot int, tag string"))
        # rows of one class differ only in the id; one of those with a bitmap stands for it
        for turn in range(0, 64, 9):
            sig = written.withColumn("cls", _renamed(turn))
            self.named = _class_name(turn)
            self.reps = materialize(sig.where("bits IS NOT NULL").groupBy("cls").agg(
                F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("sketch").alias("sketch"),
                F.min("cls2").alias("low2"), F.max("cls2").alias("high2")))
            if not self.reps.where("low2 <> high2").limit(1).count():
                break
            discard(self.reps)  # two different sets share a name: all classes are named anew from both of their hashes
        else:
            raise RuntimeError("different sets share their hashes")
        keys = sig.where("bits IS NOT NULL").select("cls", "n", "n_hot", F.size("prefix").alias("p"), F.posexplode("prefix").alias("i", "key")) \
            .select("key", F.when((F.col("i") >= F.col("p") - F.col("n_hot")) & F.lit(salts > 1), F.pmod("cls", F.lit(salts)).cast("int"))
                    .otherwise(F.lit(-1)).alias("salt"), "n", "cls")
        tiles = materialize(keys.repartition(self.parts, "key", "salt").sortWithinPartitions("key", "salt", "n", "cls")
                            .mapInArrow(_tiles, "key long, tile long, multi boolean, ns array<int>, cs array<long>"))

        # round one: pivots, on one key in eight
        first = materialize(tiles.where("key % 8 = 0").mapInArrow(_pivot_pairs(pct), "a long, b long, key long").distinct())
        lone = first.where("key IS NOT NULL").select("key", "a")
        low = lone.groupBy("key").agg(F.min("a").alias("low"))
        across = lone.join(low, "key").where("a <> low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        tried = materialize(self._bounded(first.where("key IS NULL").select("a", "b").union(across).distinct()))
        links = self._settle(tried, None)
        comp = components(links)

        # round two: tiles that still hold two components; those of equal members count as one tile of weight w
        single = tiles.where("NOT multi").groupBy(F.xxhash64("cs").alias("x"), F.xxhash64(F.lit(1), "cs").alias("y")).agg(
            F.count(F.lit(1)).alias("w"), F.first("ns").alias("ns"), F.first("cs").alias("cs"))
        single = materialize(single.select(F.monotonically_increasing_id().alias("key"), F.lit(0).cast("long").alias("tile"), "w", "ns", "cs"))
        met = self._met_in_small(single.where(F.size("cs") <= SMALL), comp)
        large = single.where(F.size("cs") > SMALL).select(F.struct("key", F.lit(True).alias("one")).alias("key"), "tile", "ns", "cs").unionByName(
            tiles.where("multi").select(F.struct("key", F.lit(False).alias("one")).alias("key"), "tile", "ns", "cs"))
        held = self._held_by_large(large, comp)
        late = materialize(self._bounded(met.join(tried, ["a", "b"], "left_anti")).union(held))
        if late.limit(1).count():
            more = self._settle(late, comp)
            discard(comp)
            comp = components(links.union(more))
            discard(more)

        labelled = sig.select("doc_id", F.col("n").alias("n_shingles"), "cls", "tag").join(comp, F.col("cls") == F.col("node"), "left") \
            .select("doc_id", "tag", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("label", "cls")).alias("label"))
        labelled = materialize(labelled)
        discard(written, self.reps, tiles, first, tried, links, single, late, comp, *self.spare)  # all that the result needs is in ``labelled``
        lowest = materialize(labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id")))
        return labelled.join(lowest, "label", "left").select(
            "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "label", "tag")


def jaccard_components(docs: DataFrame, percent: int = 75, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links): one row for each row."""
    return JaccardJoin(docs, percent, k, id_col, text_col).run().drop("label", "tag")


def one_of_each(docs: DataFrame, percent: int = 75, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null last), then the
    smallest digest of its text. Rows with an empty set all stay, and so do rows that repeat both the id
    and the text of one that stays. Rows are told apart by id and digest, so unrelated texts under one
    id do not share their fate."""
    digest = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    tagged = docs.withColumn("__tag", digest)
    rows = JaccardJoin(tagged, percent, k, id_col, text_col, "__tag").run()
    first = rows.where("label IS NOT NULL").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tag")).alias("r"))
    stay = first.select(F.col("r.doc_id").alias("__id"), F.col("r.tag").alias("__t")).unionByName(
        rows.where("label IS NULL").select(F.col("doc_id").alias("__id"), F.col("tag").alias("__t"))).distinct()
    same = (F.col("__tag") == F.col("__t")) & F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
    return tagged.join(stay, same, "left_semi").select(*docs.columns)
