"""Token files on shared storage: ascending shards, written once each and safe to write again.

Documents are range-partitioned by id, so shard k holds ids below those of shard k + 1. A task
writes its file under a temporary name and moves it into place, so a retried task leaves the same
file. Nothing but a small manifest (one row for each shard) leaves the writing tasks.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_memory, input_bytes, open_fs, parts_for
from .tokens import encoder, slices

NULL_ID = -(1 << 63)    # stands for a null id inside files
SEGMENT_IDS = 1 << 20   # ids that a writing task holds at a time
PIECES = 320_000        # pieces that a writing worker remembers: texts come in order of id, and it holds little else


def put_file(folder: str, name: str, chunks) -> str:
    """Write ``chunks`` (bytes-like) as folder/name; returns its URI."""
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    tmp = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as out:
        for c in chunks:
            out.write(memoryview(c).cast("B") if not isinstance(c, bytes) else c)
    fs.move(tmp, f"{path}/{name}")
    return f"{folder}/{name}"


def shards_for(docs: DataFrame) -> int:
    """Shards of 16 MB of input each, larger (up to 1 GB) where that would make over 4,096: tasks
    stream, so a shard's size does not bound their memory."""
    return parts_for(docs, min(1 << 30, max(16 << 20, input_bytes(docs) // 4096)))


def ascending(docs: DataFrame, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) range-partitioned and sorted by id (equal ids by text)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.repartitionByRange(shards or shards_for(docs), "doc_id").sortWithinPartitions("doc_id", "text")


def segments(it, tokenizer: str, end: int, segment_ids: int = SEGMENT_IDS, special: bool = False):
    """Documents of a partition in order, about ``segment_ids`` ids at a time and never cut:
    (ids of documents, token ids, offsets)."""
    enc, docs, parts, lengths, held = encoder(tokenizer, special, PIECES), [], [], [], 0

    def done():
        at = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int64)
        return np.array(docs, np.int64), np.concatenate(parts), at
    for b in it:
        own, texts = b.column(0).to_pylist(), b.column(1)
        for lo, hi in slices(texts):
            ids, at = enc.encode(texts[lo:hi], end)
            docs += [NULL_ID if d is None else d for d in own[lo:hi]]
            parts.append(ids.astype("<u4"))
            lengths.append(np.diff(at))
            held += len(ids)
            if held >= segment_ids:
                yield done()
                docs, parts, lengths, held = [], [], [], 0
    if docs:
        yield done()
    docs, parts, lengths = [], [], []
    free_memory()


def shard_number() -> int:
    return TaskContext.get().partitionId()


def doc_id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)
