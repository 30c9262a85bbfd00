"""Token counts by separator scan over flat, unindexed token files.

A file is a bare run of little-endian ids, each document closed by the end-of-document id. It is
cut into blocks of equal size with no regard to documents; a vectorised search finds the separators
of a block. A block reports its separators, the ids before its first and after its last one; a
prefix scan over these small summaries gives each block the number of documents closed before it
and the ids carried in, and only then does each block's first document get its true length.

Cases: a document may span any number of blocks; ids after the last separator of a file belong to
no closed document and are reported by ``block_summaries`` as ``after``; an empty file or table
gives no rows; null and empty texts count their end id; null ids stay null; equal ids each get a row.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, open_fs, shared_dir
from .token_files import doc_id_array, put_file, segments, shard_number

BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, dtype: str = "<u2",
               id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Write a flat token file for each partition of ``docs``, in the order of its rows; texts are
    not shuffled. Returns the folder and a table of (shard, ordinal, doc_id): which document is the
    n-th of its file."""
    folder = folder or shared_dir(docs.sparkSession, "flat")
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def write(it):
        segs, doc_ids = segments(it, tokenizer, end), []

        def chunks(first):
            for own, ids, _ in chain([first], segs):
                doc_ids.append(own)
                if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
                    raise ValueError(f"id {int(ids.max())} does not fit {dtype}")
                yield ids.astype(dtype).tobytes()
        first = next(segs, None)
        if first is not None:
            shard = shard_number()
            put_file(folder, f"shard-{shard:06d}.bin", chunks(first))
            every = np.concatenate(doc_ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(every), shard)), pa.array(np.arange(len(every))),
                                              doc_id_array(every)], names=["shard", "ordinal", "doc_id"])

    order = materialize(src.mapInArrow(write, "shard long, ordinal long, doc_id long"))
    return folder, order


def blocks_of(spark, folder: str, dtype: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """(path, shard, block, lo, n) for every block of the folder's files; the folder is listed,
    no file is read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    step = block_ids * np.dtype(dtype).itemsize
    f = files.select("path", F.regexp_extract("path", r"shard-(\d+)\.", 1).cast("long").alias("shard"), "length")
    b = f.where("length > 0").select("path", "shard", "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {step})")).alias("block"))
    return b.select("path", "shard", "block", (F.col("block") * step).alias("lo"),
                    F.least(F.lit(step).cast("long"), F.col("length") - F.col("block") * step).alias("n"))


def _scan(dtype: str, sep: int):
    def run(it):
        for b in it:
            for path, shard, block, lo, n in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
                fs, p = open_fs(path)
                with fs.open_input_file(p) as f:
                    ids = np.frombuffer(f.read_at(n, lo), dtype)
                at = np.flatnonzero(ids == sep)
                inner = np.diff(at) if len(at) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int64()), pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()),
                     pa.array([len(at)], pa.int64()), pa.array([int(at[0]) + 1 if len(at) else len(ids)], pa.int64()),
                     pa.array([len(ids) - 1 - int(at[-1]) if len(at) else len(ids)], pa.int64()),
                     pa.array([inner.tolist()], pa.list_(pa.int64()))],
                    names=["shard", "block", "n_ids", "seps", "before", "after", "inner"])
    return run


def block_summaries(blocks: DataFrame, sep: int, dtype: str = "<u2") -> DataFrame:
    """For each block: ids, separators, ids up to and with the first separator (all if none), ids
    after the last (all if none), and the lengths of documents that lie wholly between two."""
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.select("path", "shard", "block", "lo", "n").repartition(tasks).mapInArrow(
        _scan(dtype, sep), "shard long, block long, n_ids long, seps long, before long, after long, inner array<long>")


def stitch(summaries: DataFrame) -> DataFrame:
    """(shard, ordinal, n_tokens) of each closed document, by a prefix scan over a file's block
    summaries: documents closed before the block, and the position after the last separator that
    any earlier block holds, where the block's first document began."""
    scan = summaries.selectExpr(
        "*", "sum(n_ids) OVER (PARTITION BY shard ORDER BY block) AS upto",
        "sum(seps) OVER (PARTITION BY shard ORDER BY block) - seps AS closed",
    ).selectExpr(
        "shard", "seps", "closed", "inner", "upto - n_ids + before AS first_end",
        "coalesce(last(CASE WHEN seps > 0 THEN upto - after END, true) OVER (PARTITION BY shard ORDER BY block "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS open_from")
    lengths = scan.where("seps > 0").select("shard", "closed", F.posexplode(
        F.concat(F.array(F.col("first_end") - F.col("open_from")), "inner")).alias("k", "n_tokens"))
    return lengths.select("shard", (F.col("closed") + F.col("k")).alias("ordinal"), "n_tokens")


def token_counts(docs: DataFrame, tokenizer: str, end: int, dtype: str = "<u2", block_ids: int = BLOCK_IDS,
                 folder: str | None = None) -> DataFrame:
    """Write flat files for ``docs``, scan them, and return doc_id, shard, ordinal, n_tokens."""
    folder, order = write_flat(docs, tokenizer, end, folder, dtype)
    blocks = blocks_of(docs.sparkSession, folder, dtype, block_ids)
    counted = stitch(materialize(block_summaries(blocks, end, dtype)))
    return order.join(counted, ["shard", "ordinal"], "left").select("doc_id", "shard", "ordinal", "n_tokens")
