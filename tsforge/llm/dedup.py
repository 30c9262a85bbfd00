"""Exact dedup against a persistent digest index (DataFrame operations only).

The index is a parquet table of (digest, first_id), bucketed and sorted by digest, in a folder of
its own. A batch is reduced to one row per digest, dropped against the index by a sort-merge
anti-join (the index side needs no exchange) and the rest is appended.

Cases: a null text counts as empty; empty texts are equal to each other; a null id never becomes
a group's id unless all ids of the group are null; rows that repeat an id with an equal text are
one document and carry the same verdict; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, materialize, parts_for, shared_dir


def digest_of(text_col: str):
    """SHA-256 of the text with each run of white space as one space; a null text is empty."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WS, " "), 256)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(F.col(id_col).alias("doc_id"), digest_of(text_col).alias("digest"))


class DigestIndex:
    """Digest index at ``path`` on shared storage. Opening a path again finds what earlier
    sessions appended; ``buckets`` is fixed when the index is made (about one per 100 MB of
    digests expected)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.sha1(path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, first_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        """The index with its bucketing (joins on digest need no exchange of it)."""
        return self.spark.table(self.name)

    def plain(self) -> DataFrame:
        """The same rows as plain files, so that a join may split a hot digest."""
        return self.spark.read.schema("digest string, first_id long").parquet(self.path)

    def fresh(self, batch: DataFrame) -> DataFrame:
        """One row for each digest of ``batch`` that the index lacks, with its smallest id."""
        firsts = batch.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
        return firsts.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def drop(self) -> None:
        """Delete the index and its catalog entry."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)

    def append(self, batch: DataFrame) -> None:
        """Add what is new in ``batch``. A repeated call adds nothing, so a job that died after
        the append can simply run it again."""
        self.fresh(batch).select("digest", "first_id").repartition(self.buckets, "digest") \
            .sortWithinPartitions("digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2,
                buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Deduplicate a whole table through a digest index, in ``batches`` of ascending ids so that
    the smallest id of each group enters the index. Returns doc_id, keep_id, group_size, kept,
    text_sha256: one row for each input row.

    Digests are computed once and written to the shared folder. The index lies under ``path`` and is
    found there again by later runs; without a path it is only for this run and deleted at its end. It is
    made with one bucket for each 64 MB of digests, 16 at least. The last join, which brings a
    group's id to each of its rows, has one row per digest on one side and lets AQE split a hot
    digest on the other.
    """
    spark = docs.sparkSession
    dig = materialize(digests(docs, id_col, text_col))
    index = DigestIndex(spark, path or shared_dir(spark, "digests"), buckets or parts_for(dig, 64 << 20, 16))
    cuts = dig.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    lo = None
    for hi in [*sorted(set(cuts)), None]:
        part = dig
        if lo is not None:
            part = part.where(F.col("doc_id") > F.lit(int(lo)))
        if hi is not None:
            part = part.where(F.col("doc_id") <= F.lit(int(hi)))
        elif lo is not None:
            part = dig.where((F.col("doc_id") > F.lit(int(lo))) | F.col("doc_id").isNull())
        index.append(part)
        lo = hi
    sizes = dig.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = materialize(sizes.join(index.plain().groupBy("digest").agg(F.min("first_id").alias("keep_id")), "digest"))
    if path is None:
        index.drop()
    return dig.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))
