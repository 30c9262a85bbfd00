"""Global row numbers and permutations without ranking in one task.

``row_numbers`` sorts by ranges: each task numbers its own range, and the ranges' sizes say where each
starts. ``permuted_row`` maps row numbers one to one onto themselves by a keyed bijection (a Feistel
network over two digits, followed along its cycle until it falls below the number of rows), so a
permutation of all rows needs no sort and no state at all.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tsforge.session import materialize

ROUNDS = 4
# Multipliers of the rounds and the modulus of their products (fixed values).
MULTIPLIERS = (1_103_515_245, 22_695_477, 1_664_525, 134_775_813)
MODULUS = 1 << 31


def row_numbers(df: DataFrame, order: list[str], out: str = "_row") -> DataFrame:
    """Number all rows from 0 in the order of ``order`` (which should tell all rows apart, so that no
    range is large). Written; the ranges' sizes are a row for each partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return numbered(df.repartitionByRange(parts, *order).sortWithinPartitions(*order), out)


def numbered(df: DataFrame, out: str = "_row") -> DataFrame:
    """Number all rows from 0 by their place in the partitions of ``df``. Written."""
    low = (1 << 33) - 1
    m = materialize(df.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = m.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over the partitions
    first = materialize(sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first")))
    return m.withColumn("_part", part).join(F.broadcast(first), "_part") \
        .withColumn(out, F.col("_first") + F.col("_at").bitwiseAND(F.lit(low))).drop("_at", "_part", "_first")


def _mixed(x, k, r: int):
    """Round function: two multiplications modulo 2^31 with a shift between."""
    t = ((x % MODULUS + 1) * MULTIPLIERS[r] + (k % MODULUS) * 40_503 + r) % MODULUS
    t = ((t ^ (t >> 15)) * MULTIPLIERS[r - 1]) % MODULUS
    return t ^ (t >> 13)


def permute(x: np.ndarray, n: int, key: np.ndarray | int) -> np.ndarray:
    """Image of row numbers 0..n-1 under the bijection of ``key`` (one for all, or one for each)."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = -(-n // a)
    out = np.array(x, np.int64)
    k = np.broadcast_to(np.asarray(key, np.int64), out.shape)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // b, out[todo] % b
        for r in range(ROUNDS):
            if r % 2 == 0:
                left = (left + _mixed(right, k[todo], r)) % a
            else:
                right = (right + _mixed(left, k[todo], r)) % b
        out[todo] = left * b + right
        todo = todo[out[todo] >= n]
    return out


def permuted_row(row: str, n: int, key: str | int) -> Column:
    """Column form of ``permute``; ``key`` is a number or a column of numbers."""
    @pandas_udf("long")
    def run(x, k):
        import pandas as pd
        return pd.Series(permute(x.to_numpy(), n, k.to_numpy()))
    return run(F.col(row), F.col(key) if isinstance(key, str) else F.lit(key).cast("long"))
