"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are dealt, in a random but repeatable order, into blocks. With weight w,
block j (from 0) of a source has release time floor(j / w) and deadline ceil((j + 1) / w); serving
released blocks by earliest deadline keeps every source less than one block away from its share of
any prefix. Weights are taken as whole numbers of about 2^60 parts, so that rounding does not add up
over the slots (``grain`` rounds them to so many parts instead). When a source runs out, the others go
on with the same ratios in a new phase; there are at most as many phases as sources.

The schedule has a row for each block (not for each row) and is made on the driver, about 50 bytes a
block; rows find their slot by a join with it on source and block. Any number of sources is taken.

Cases: a null source is a source of its own; null and repeated ids are rows like others; empty and
long texts do not matter, for rows are counted; an empty table gives no rows; rows are never
dropped or repeated; other columns pass through unless they clash with the added ones
(``mix_*``), which replace them.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

ADDED = ["mix_block", "mix_release", "mix_deadline", "mix_phase", "mix_slot", "mix_pos"]


def apportion(weights: list[float], grain: int) -> list[int]:
    """Whole parts of ``grain`` in proportion to the weights, at least one each (largest
    remainders)."""
    grain = max(grain, len(weights))
    total = sum(weights)
    exact = [w / total * grain for w in weights]
    parts = [max(1, math.floor(x)) for x in exact]
    order = sorted(range(len(parts)), key=lambda i: (parts[i] - exact[i], i))
    k = 0
    while sum(parts) < grain:
        parts[order[k % len(order)]] += 1
        k += 1
    while sum(parts) > grain:
        i = max((i for i in range(len(parts)) if parts[i] > 1), key=lambda i: (parts[i] - exact[i], i))
        parts[i] -= 1
    return parts


def exact_parts(weights: list[float], bits: int = 60) -> list[int]:
    """Whole numbers in proportion to the weights, to 2^-bits of their sum."""
    exact = [Fraction(w) for w in weights]
    total = sum(exact)
    return [max(1, int(w / total * (1 << bits))) for w in exact]


def earliest(parts: list[int]):
    """The earliest-deadline-first schedule, slot by slot: (source, block, release, deadline)."""
    grain = sum(parts)
    waiting = [(0, i, 0) for i in range(len(parts))]  # (release, source, block)
    ready: list[tuple[int, int, int, int]] = []  # (deadline, source, block, release)
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            release, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * grain // parts[i]), i, j, release))
        deadline, i, j, release = heapq.heappop(ready)
        if deadline < slot + 1:
            raise ValueError(f"block {j} of source {i} misses its deadline {deadline}")
        yield i, j, release, deadline
        heapq.heappush(waiting, ((j + 1) * grain // parts[i], i, j + 1))
        slot += 1


def period(parts: list[int]) -> list[int]:
    """One period of the earliest-deadline-first schedule: the source of each slot."""
    return [i for i, *_ in islice(earliest(parts), sum(parts))]


def schedule(blocks: list[int], parts: list[int]) -> np.ndarray:
    """A row for each slot: source, block, phase, release and deadline (from the phase's first
    slot). A phase ends at the slot after which a source has no block left."""
    out = np.empty((sum(blocks), 5), np.int64)
    first, slot, phase = [0] * len(blocks), 0, 0
    live = [i for i, n in enumerate(blocks) if n > 0]
    while live:
        own = [parts[i] for i in live]
        g = math.gcd(*own)
        start = [first[i] for i in live]
        for q, j, release, deadline in earliest([x // g for x in own]):
            i = live[q]
            out[slot] = i, start[q] + j, phase, release, deadline if deadline < 1 << 62 else 1 << 62
            slot += 1
            first[i] += 1
            if first[i] == blocks[i]:
                break
        live = [i for i in live if first[i] < blocks[i]]
        phase += 1
    return out


def positions(rows: DataFrame, n: int, source_col: str, id_col: str) -> DataFrame:
    """Add ``__mix_n``: a repeatable random position of each of the ``n`` rows in its source. Rows
    are ranked in hash buckets (2,000 to 200,000 rows each), so no task ranks a whole source."""
    buckets = max(1, min(math.ceil(n / 2_000), max(1_000, math.ceil(n / 200_000))))
    h = F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.lit(7))
    keyed = rows.withColumn("__mix_h", h).withColumn("__mix_b", F.pmod(F.shiftright("__mix_h", 8), F.lit(buckets)))
    sizes = materialize(keyed.groupBy(F.col(f"`{source_col}`").alias("s"), F.col("__mix_b").alias("b")).agg(F.count(F.lit(1)).alias("c")))
    before = sizes.selectExpr("s AS __mix_s", "b AS __mix_c", "sum(c) OVER (PARTITION BY s ORDER BY b) - c AS __mix_base")
    local = keyed.selectExpr("*", f"row_number() OVER (PARTITION BY `{source_col}`, __mix_b ORDER BY __mix_h, `{id_col}`) - 1 AS __mix_r")
    cond = F.col(f"`{source_col}`").eqNullSafe(F.col("__mix_s")) & (F.col("__mix_b") == F.col("__mix_c"))
    return local.join(before, cond).withColumn("__mix_n", F.col("__mix_base") + F.col("__mix_r")) \
        .drop("__mix_s", "__mix_c", "__mix_base", "__mix_h", "__mix_b", "__mix_r")


def mix(docs: DataFrame, weights: dict | None = None, block_rows: int = 16, grain: int | None = None, alpha: float = 0.5,
        source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """Schedule all rows. ``weights`` maps sources to target weights (missing ones share the rest
    evenly); by default a source's weight is its row count to the power ``alpha``; ``grain``, if given,
    rounds weights to that many parts. Adds mix_block
    (block in the source), mix_release and mix_deadline (slots, from the first slot of the phase),
    mix_phase, mix_slot (the block's place in the whole order) and mix_pos (the row's place in its
    block)."""
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    source = F.col(f"`{source_col}`")
    counts = docs.groupBy(source.alias("s")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("s").asc_nulls_first()).collect()  # one row for each source
    names = [r["s"] for r in counts]
    blocks = [math.ceil(r["n"] / block_rows) for r in counts]
    share = [float(r["n"]) ** alpha for r in counts]
    if weights is not None and counts:
        named = [weights.get(s) for s in names]
        rest = max(0.0, 1.0 - sum(w for w in named if w is not None))
        open_ = max(1, sum(w is None for w in named))
        share = [max(w if w is not None else rest / open_, 1e-9) for w in named]
    parts = (exact_parts(share) if grain is None else apportion(share, grain)) if counts else []
    made = schedule(blocks, parts)
    plan = spark.createDataFrame(
        pd.DataFrame({**{f"__mix_{c}": made[:, k] for k, c in enumerate(("of", "at", "phase", "release", "deadline"))},
                      "__mix_slot": np.arange(len(made))}),
        "__mix_of long, __mix_at long, __mix_phase long, __mix_release long, __mix_deadline long, __mix_slot long")
    numbers = spark.createDataFrame([(s, i) for i, s in enumerate(names)], T.StructType(
        [T.StructField("__mix_s", docs.schema[source_col].dataType), T.StructField("__mix_i", T.LongType())]))
    n, block = F.col("__mix_n"), F.floor(F.col("__mix_n") / block_rows)
    placed = positions(docs, sum(r["n"] for r in counts), source_col, id_col).withColumn("__mix_block", block)
    b = placed.join(numbers, source.eqNullSafe(F.col("__mix_s"))) \
        .join(plan, (F.col("__mix_i") == F.col("__mix_of")) & (F.col("__mix_block") == F.col("__mix_at")))
    return b.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col("__mix_block").alias("mix_block"),
        F.col("__mix_release").alias("mix_release"), F.col("__mix_deadline").alias("mix_deadline"),
        F.col("__mix_phase").cast("int").alias("mix_phase"), F.col("__mix_slot").alias("mix_slot"),
        F.pmod(n, F.lit(block_rows)).alias("mix_pos"))
