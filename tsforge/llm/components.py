"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round. Each node points the neighbours it may move (larger ones, or smaller ones and
    itself) at the smallest node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
    moved = (both.where("v > u") if large else both).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    out = materialize(moved.where("a <> b").distinct())
    discard(low, edges)
    return out


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): the smallest node of its component. The
    edge set shrinks to stars; each round is written to the shared folder and takes the place of the
    one before. The result is such a table too. Raises if the stars are
    not reached in ``max_rounds`` (rounds grow with the logarithm of the longest path)."""
    def mark(e):
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    old = mark(e)
    for _ in range(max_rounds):
        e = _star(_star(e, True), False)
        new = mark(e)
        if new == old:
            out = materialize(e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))
            discard(e)
            return out
        old = new
    raise RuntimeError("components did not settle")
