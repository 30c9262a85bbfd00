"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node stands for a distinct sequence of first turns; the root for none. Prefixes are named by the
exclusive or of one 128-bit digest for each (place, role, text), a running value that long
conversations compute piece by piece, so neither texts nor whole conversations are gathered.

A node belongs to its smallest member; what one conversation owns is a path down to its last turn.
Nodes whose owners' ids share a block, and whose depths share a segment, form a shard. Within a
shard the nodes come sorted by reverse level order, deepest first, and each passes its totals to its
parent through a priority queue ordered like the nodes; the queue spills sorted runs to the shared
folder beyond a bound, so a shard of any size needs bounded memory. Totals of nodes whose parent lies
in another shard (shard roots) then go to the nodes on their conversation's path above them: those
hold exactly the subtrees that the shard root lies in.

Cases: turns are ordered by number, null first, and equal numbers by digest; null roles and texts are
empty; a conversation without turns is a member of the root; rows without a conversation id belong to
no conversation; repeated rows are turns like others; an empty table has no members, so no root and
no rows; very long conversations are cut into segments of ``SEGMENT`` turns; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import crc_id, discard, materialize, open_fs, parts_for, shared_dir

SEGMENT_BITS = 12      # turns of a conversation, or numbers of turns, that are handled together: 2^12
BLOCK_BITS = 8         # conversation ids whose nodes form a shard: 2^8
PIECE_BITS = 12        # conversation ids that are joined to one piece of a node's list: 2^12
QUEUE = 1 << 20        # messages that a queue holds in memory
_NODE = ["depth", "k1", "k2"]


def digest_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) of a table (conv_id, turn, role, text): turns as conv_id, pos (from 1),
    h1, h2 (digest of role and text) and n_words; conversations as conv_id, n_turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("n_words"))
    rows = rows.withColumn("bucket", F.shiftright("turn", SEGMENT_BITS))
    # place = rows in earlier buckets of turn numbers + place in the own one
    sizes = materialize(rows.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("size")))
    before = W.partitionBy("conv_id").orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.sum("size").over(before)).where("offset > 0").select(
        F.col("conv_id").alias("c"), F.col("bucket").alias("b"), "offset")
    own = W.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "h1", "h2")
    placed = rows.withColumn("place", F.row_number().over(own)).join(
        offsets, (F.col("conv_id") == F.col("c")) & F.col("bucket").eqNullSafe(F.col("b")), "left")
    turns = materialize(placed.select("conv_id", (F.col("place") + F.coalesce("offset", F.lit(0))).alias("pos"), "h1", "h2", "n_words"))
    convs = materialize(sizes.groupBy("conv_id").agg(F.sum("size").alias("n_turns")))
    discard(sizes)
    return turns, convs


def splice_heads(turns: DataFrame, convs: DataFrame, group: int, most: int) -> DataFrame:
    """Conversations that branch off another: the first h = crc32(id) % (most + 1) turns of each come
    from the conversation id - id % group (all of them if it has fewer, none if there is none), and its
    own turns after its first h follow."""
    each = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (crc_id("conv_id") % (most + 1)).alias("h"))
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    each = each.join(lengths, "base", "left").withColumn("short", F.greatest(F.lit(0), F.col("h") - F.coalesce("n_base", F.lit(0))))
    first = turns.where(F.col("pos") <= most).withColumnRenamed("conv_id", "base")
    heads = each.select("conv_id", "base", "h").join(first, "base").where("pos <= h").select("conv_id", "pos", "h1", "h2", "n_words")
    lag = each.where("short > 0").select("conv_id", "short")
    tails = turns.where(F.col("pos") > crc_id("conv_id") % (most + 1)).join(lag, "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce("short", F.lit(0))).alias("pos"), "h1", "h2", "n_words")
    return heads.unionByName(tails)


def _members(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each conversation and depth: the node's key k1, k2, its parent's p1, p2, and the words
    of the last turn."""
    seg = F.shiftright(F.col("pos") - 1, SEGMENT_BITS)
    t = turns.select("conv_id", "pos", seg.alias("seg"), "n_words", F.xxhash64("h1", "h2", "pos").alias("x1"), F.xxhash64("pos", "h2", "h1").alias("x2"))
    sums = t.groupBy("conv_id", "seg").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    before = W.partitionBy("conv_id").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.withColumns({c: F.expr(f"bit_xor({s})").over(before) for c, s in (("c1", "s1"), ("c2", "s2"))}).where("seg > 0").select("conv_id", "seg", "c1", "c2")
    run = W.partitionBy("conv_id", "seg").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    t = t.withColumns({c: F.expr(f"bit_xor({x})").over(run) for c, x in (("r1", "x1"), ("r2", "x2"))}).join(carry, ["conv_id", "seg"], "left")
    k1, k2 = (F.col(r).bitwiseXOR(F.coalesce(c, F.lit(0).cast("long"))) for r, c in (("r1", "c1"), ("r2", "c2")))
    t = t.select("conv_id", F.col("pos").alias("depth"), k1.alias("k1"), k2.alias("k2"),
                 k1.bitwiseXOR(F.col("x1")).alias("p1"), k2.bitwiseXOR(F.col("x2")).alias("p2"), "n_words")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("n_words"))
    return materialize(t.unionByName(root))


class MessageQueue:
    """A priority queue of (key, leaves, saved) that keeps at most ``limit`` messages in memory and
    the rest in sorted runs in ``folder``."""

    def __init__(self, folder: str, limit: int = QUEUE):
        self.folder, self.limit = folder, limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (next message of a run, the run's number)
        self.runs: list = []

    def push(self, key: tuple, leaves: int, saved: int) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, (*key, leaves, saved))

    def _spill(self) -> None:
        fs, base = open_fs(self.folder)
        fs.create_dir(base, recursive=True)
        path = f"{base}/{uuid.uuid4().hex}.arrow"
        self.heap.sort()
        schema = pa.schema([(f"f{i}", pa.int64()) for i in range(5)])
        with fs.open_output_stream(path) as out, pa.ipc.new_stream(out, schema) as w:
            for lo in range(0, len(self.heap), 1 << 14):
                cols = zip(*self.heap[lo:lo + (1 << 14)], strict=True)
                w.write_batch(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema))
        self.heap = []

        def rows():
            with fs.open_input_stream(path) as src:
                for b in pa.ipc.open_stream(src):
                    yield from zip(*(c.to_pylist() for c in b.columns), strict=True)
            fs.delete_file(path)

        self.runs.append(rows())
        self._advance(len(self.runs) - 1)

    def _advance(self, run: int) -> None:
        x = next(self.runs[run], None)
        if x is not None:
            heapq.heappush(self.heads, (x, run))

    def take(self, key: tuple) -> tuple[int, int]:
        """Sums of the messages for ``key``, which must not come after any key still waiting."""
        leaves = saved = 0
        while self.heap and self.heap[0][:3] == key:
            x = heapq.heappop(self.heap)
            leaves, saved = leaves + x[3], saved + x[4]
        while self.heads and self.heads[0][0][:3] == key:
            x, run = heapq.heappop(self.heads)
            leaves, saved = leaves + x[3], saved + x[4]
            self._advance(run)
        return leaves, saved

    def empty(self) -> bool:
        return not self.heap and not self.heads


def _pass_totals(folder: str, limit: int):
    """Rows (block, seg, depth, k1, k2, p1, p2, inner, leaves, saved), a shard's rows together and
    deepest first -> (depth, k1, k2, leaves, saved) summed over the node's subtree in the shard."""
    def run(it):
        shard, queue = None, MessageQueue(folder, limit)
        for b in it:
            out = []
            for block, seg, depth, k1, k2, p1, p2, inner, leaves, saved in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (block, seg) != shard:
                    if not queue.empty():
                        raise RuntimeError("messages left over in a shard")
                    shard = block, seg
                more = queue.take((-depth, k1, k2))
                leaves, saved = leaves + more[0], saved + more[1]
                out.append((depth, k1, k2, leaves, saved))
                if inner:
                    queue.push((1 - depth, p1, p2), leaves, saved)
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[*_NODE, "leaves", "saved"])
        if not queue.empty():
            raise RuntimeError("messages left over in a shard")
    return run


def _hash_ends(it):
    """Rows (depth, k1, k2, chunk, piece), a node's pieces together and in order -> its digest."""
    node, sha = None, None
    for b in it:
        out = []
        for depth, k1, k2, _, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (depth, k1, k2) != node:
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = (depth, k1, k2), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(piece.encode())
        cols = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=[*_NODE, "ends"])
    if node:
        yield pa.RecordBatch.from_arrays([*(pa.array([c], pa.int64()) for c in node), pa.array([sha.hexdigest()])], names=[*_NODE, "ends"])


def prefix_trie(turns: DataFrame, convs: DataFrame, queue: int = QUEUE, block_bits: int = BLOCK_BITS) -> DataFrame:
    """A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (over its subtree, words that its members share beyond the first) and
    ends_sha256 (digest of the sorted ids of the conversations that end there)."""
    spark = turns.sparkSession
    members = _members(turns, convs)
    parts = parts_for(members)
    nodes = materialize(members.groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("n_words").alias("n_words")))
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.where("depth > 0").select(*up).groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes2 = materialize(nodes.join(children, _NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
                         .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))

    block, parent_block = (F.shiftright(c, block_bits) for c in ("conv_id", "parent_conv_id"))
    seg = F.shiftright("depth", SEGMENT_BITS)
    inner = F.coalesce((block == parent_block) & (seg == F.shiftright(F.col("depth") - 1, SEGMENT_BITS)), F.lit(False))
    rows = nodes2.select(block.alias("block"), seg.alias("seg"), *_NODE, "p1", "p2", inner.alias("inner"),
                         (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"))
    ordered = rows.repartition(parts, "block", "seg").sortWithinPartitions("block", "seg", F.desc("depth"), "k1", "k2")
    local = materialize(ordered.mapInArrow(_pass_totals(shared_dir(spark, "trie-queue"), queue), "depth long, k1 long, k2 long, leaves long, saved long"))

    # shard roots -> what each stretch of their conversation's path above them still has to add
    roots = nodes2.where(~inner & (F.col("depth") > 0)).select("conv_id", *_NODE).join(local, _NODE)
    add = roots.select("conv_id", F.col("depth").alias("d"), "leaves", "saved", F.explode(F.sequence(F.lit(0), F.shiftright("depth", SEGMENT_BITS))).alias("seg"))
    below = F.when(F.col("seg") == F.shiftright("d", SEGMENT_BITS), F.col("d"))  # in earlier segments all depths are above it
    add = add.groupBy("conv_id", "seg", below.alias("below")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    above = members.select("conv_id", seg.alias("seg"), *_NODE).join(add, ["conv_id", "seg"]).where("below IS NULL OR depth < below").select(*_NODE, "leaves", "saved")

    ends = members.groupBy("conv_id").agg(F.max(F.struct(*_NODE)).alias("last")).select("last.*", F.shiftright("conv_id", PIECE_BITS).alias("chunk"), "conv_id")
    pieces = ends.groupBy(*_NODE, "chunk").agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("piece"))
    digests = pieces.repartition(parts, *_NODE).sortWithinPartitions(*_NODE, "chunk").mapInArrow(_hash_ends, "depth long, k1 long, k2 long, ends string")

    none = F.lit(None).cast("string")
    facts = local.withColumn("ends", none).unionByName(above.withColumn("ends", none)).unionByName(
        digests.select(*_NODE, F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "ends"))
    facts = facts.groupBy(*_NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("ends").alias("ends"))
    out = materialize(nodes2.join(facts, _NODE).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
    discard(members, nodes, nodes2, local)
    return out
