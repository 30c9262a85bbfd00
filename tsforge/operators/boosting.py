"""Second-order gradient boosting of regression trees (F6): squared error, L2 penalty, histograms.

Each round fits a tree to the gradients g = prediction - label (the Hessian of squared error is 1) and
each level of it is one job: tasks add up gradients and row counts in (node, feature, bin) cells, a
grouped aggregation merges them, and the driver, which gets at most nodes x features x bins rows, takes
for each node the split of largest gain

    G_L^2 / (H_L + l2) + G_R^2 / (H_R + l2) - G^2 / (H + l2).

Gradients are whole multiples of a power of two, so their sums do not depend on the order they are added
in: the same rows give the same trees whatever the partitions, and ties are true ties. They go to the
first feature, then the lowest bin, then missing values to the left.

Bins hold about equal numbers of training rows: a cut is the value at which a feature's rank passes a
multiple of n / bins. Rows are kept as blocks of bin numbers; predictions so far are stored with them
every few rounds, so that a job never replays more than those rounds' trees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators.ranks import row_numbers
from tsforge.session import materialize, reuse_input

BLOCK_ROWS = 65_536
REPLAY = 8  # rounds whose trees are replayed before predictions are stored again


@dataclass
class Tree:
    """Nodes in level order; a leaf has feature -1. Rows with bin <= ``cut`` go left, those without a
    value (bin 0) where ``missing_left`` says."""
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    child: list = field(default_factory=list)   # left child; the right one follows
    weight: list = field(default_factory=list)

    def add(self, weight: float) -> int:
        for a, v in ((self.feature, -1), (self.cut, 0), (self.missing_left, True), (self.child, -1), (self.weight, weight)):
            a.append(v)
        return len(self.feature) - 1

    def place(self, bins: np.ndarray) -> np.ndarray:
        """Node of each row of ``bins`` (features x rows)."""
        feature, cut, left, child = (np.array(a) for a in (self.feature, self.cut, self.missing_left, self.child))
        at, cols = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        while True:
            f = feature[at]
            on = np.flatnonzero(f >= 0)
            if not len(on):
                return at
            b = bins[f[on], cols[on]]
            go_left = np.where(b == 0, left[at[on]], b <= cut[at[on]])
            at[on] = child[at[on]] + np.where(go_left, 0, 1)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.weight)[self.place(bins)]


@dataclass
class Booster:
    """A fitted model; ``predict`` adds the column ``prediction``."""
    cols: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def bins(self, values: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.where(np.isnan(v), 0, np.searchsorted(c, v) + 1) for v, c in zip(values, self.cuts, strict=True)]).astype(np.int32)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        from pyspark.sql.functions import pandas_udf
        model = self

        @pandas_udf("double")
        def run(x):  # a struct of the features comes as a frame
            b = model.bins([x[c].to_numpy(float) for c in model.cols])
            p = np.full(len(x), model.base)
            for t in model.trees:
                p = p + t.predict(b)
            import pandas as pd
            return pd.Series(p)
        return df.withColumn(out, run(F.struct(*[F.col(c).cast("double").alias(c) for c in self.cols])))


def quantile_cuts(df: DataFrame, cols: list[str], bins: int) -> list[np.ndarray]:
    """Cuts of each feature: the distinct values at which the rank passes a multiple of n / bins, but
    for the largest. One range-partitioned sort of all features; bins x features rows come back."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("v")) for i, c in enumerate(cols)]))
    long = df.select(pairs.alias("p")).select("p.f", "p.v").where("v IS NOT NULL")
    ranked = row_numbers(long.withColumn("tie", F.monotonically_increasing_id()), ["f", "v", "tie"])
    size = ranked.groupBy("f").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
    r = F.col("_row") - F.col("first")
    passed = F.floor((r + 1) * bins / F.col("n")) > F.floor(r * bins / F.col("n"))
    got = ranked.join(F.broadcast(size), "f").where(passed & (F.col("v") < F.col("top"))).select("f", "v").distinct().toPandas()  # size: a row for each feature
    return [np.sort(got.loc[got["f"] == i, "v"].to_numpy(float)) for i in range(len(cols))]


def _blocks(df: DataFrame, model: Booster, label: str) -> DataFrame:
    """Rows in blocks: n, bins (features x rows), y, p (label and prediction so far)."""
    cuts_model, names = model, model.cols

    def run(it):
        for b in it:
            vals = [b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(b.num_columns)]
            y = vals.pop()
            bins = cuts_model.bins(vals)
            yield pa.RecordBatch.from_arrays([pa.array([len(y)]), pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()),
                                              pa.array([np.full(len(y), cuts_model.base).tobytes()], pa.binary())], names=["n", "bins", "y", "p"])
    src = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)], F.col(label).cast("double").alias("label"))
    return src.mapInArrow(run, "n long, bins binary, y binary, p binary")


def _replay(trees: list[Tree]):
    """Blocks with the predictions of more trees added."""
    def run(it):
        for b in it:
            p = []
            for n, bins, old in zip(b.column("n").to_pylist(), b.column("bins"), b.column("p"), strict=True):
                x = np.frombuffer(bins.as_buffer(), np.int32).reshape(-1, n) if n else np.zeros((0, 0), np.int32)
                q = np.frombuffer(old.as_buffer(), float)
                for t in trees:
                    q = q + t.predict(x)
                p.append(q.tobytes())
            yield pa.RecordBatch.from_arrays([b.column("n"), b.column("bins"), b.column("y"), pa.array(p, pa.binary())], names=["n", "bins", "y", "p"])
    return run


def _cells(trees: list[Tree], tree: Tree, live: list[int], unit: float):
    """Sums of gradients (in units) and rows in the cells of the live nodes."""
    def run(it):
        slot = np.full(len(tree.feature), -1)
        slot[live] = np.arange(len(live))
        total = None
        for b in it:
            for n, bins, y, p in zip(b.column("n").to_pylist(), b.column("bins"), b.column("y"), b.column("p"), strict=True):
                x = np.frombuffer(bins.as_buffer(), np.int32).reshape(-1, n)
                q = np.frombuffer(p.as_buffer(), float)
                for t in trees:
                    q = q + t.predict(x)
                g = np.floor((q - np.frombuffer(y.as_buffer(), float)) / unit + 0.5)
                at = slot[tree.place(x)]
                on = at >= 0
                at, g, x = at[on], g[on], x[:, on]
                wide = int(x.max(initial=0)) + 1
                cell = (at[None, :] * x.shape[0] + np.arange(x.shape[0])[:, None]) * wide + x
                size = len(live) * x.shape[0] * wide
                gs, hs = np.bincount(cell.ravel(), np.tile(g, x.shape[0]), size), np.bincount(cell.ravel(), minlength=size)
                c = np.flatnonzero(hs)
                k = c // wide
                got = np.stack([k // x.shape[0], k % x.shape[0], c % wide, gs[c].astype(np.int64), hs[c]], 1)
                total = got if total is None else np.concatenate([total, got])
        if total is not None and len(total):
            key, inv = np.unique(total[:, :3], axis=0, return_inverse=True)
            g, h = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
            np.add.at(g, inv.ravel(), total[:, 3])
            np.add.at(h, inv.ravel(), total[:, 4])
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v)) for v in (*key.T, g, h)], names=["node", "f", "b", "g", "h"])
    return run


def best_splits(cells, live: list[int], unit: float, l2: float, gamma: float, least: float):
    """For each live node: (gain, feature, cut, missing_left, (G_L, H_L), (G_R, H_R)) or None. ``cells``:
    node, f, b, g, h, one row for each cell that holds rows."""
    out = []
    for k in range(len(live)):
        best = None
        mine = cells[cells["node"] == k]
        for f in sorted(mine["f"].unique()):
            c = mine[mine["f"] == f].sort_values("b")
            b, g, h = c["b"].to_numpy(), c["g"].to_numpy(), c["h"].to_numpy()
            gm, hm = (int(g[0]), int(h[0])) if b[0] == 0 else (0, 0)
            has = b > 0
            b, gl, hl = b[has], np.cumsum(g[has]), np.cumsum(h[has])
            if not len(b):
                continue
            g_all, h_all = int(gl[-1]) + gm, int(hl[-1]) + hm
            for miss in (True, False) if hm else (True,):
                a, n = (gl + gm, hl + hm) if miss else (gl, hl)
                x, y, z = a * unit, (g_all - a) * unit, g_all * unit
                gain = x * x / (n + l2) + y * y / (h_all - n + l2) - z * z / (h_all + l2)
                ok = (n >= least) & (h_all - n >= least)
                gain = np.where(ok, gain, -np.inf)
                i = int(np.argmax(gain))  # the lowest of equal cuts
                if gain[i] > 2.0 * gamma and (best is None or gain[i] > best[0] or (gain[i] == best[0] and (f, int(b[i]), not miss) < (best[1], best[2], not best[3]))):
                    best = (float(gain[i]), int(f), int(b[i]), miss, (float(x[i]), int(n[i])), (float(y[i]), int(h_all - n[i])))
        out.append(best)
    return out


def fit(df: DataFrame, cols: list[str], label: str, rounds: int = 100, depth: int = 5, eta: float = 0.1, l2: float = 1.0,
        gamma: float = 0.0, min_child: float = 1.0, bins: int = 256) -> Booster:
    """Boost ``rounds`` trees of at most ``depth`` levels. Rows without a label are left out; features
    may be null or NaN."""
    df = reuse_input(df.select(*cols, F.nanvl(F.col(label).cast("double"), F.lit(None)).alias(label)).where(F.col(label).isNotNull()))
    st = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(label)).alias("m")).first()
    if not st["n"]:
        raise ValueError("no rows with a label")
    # gradients in units of a power of two: 2^30 steps to the largest label, fewer if so many rows could overflow a sum
    bits = min(30, 61 - math.ceil(math.log2(st["n"] + 1)))
    unit = 2.0 ** (math.frexp(max(st["m"], 1e-300))[1] + 1 - bits)
    total = df.agg(F.sum(F.floor(F.col(label) / F.lit(unit) + 0.5).cast("long")).alias("s")).first()["s"]
    model = Booster(cols, quantile_cuts(df, cols, bins), total / st["n"] * unit)
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
    try:
        data = materialize(_blocks(df, model, label))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    stored = 0
    for r in range(rounds):
        if r - stored >= REPLAY:
            data, stored = materialize(data.mapInArrow(_replay(model.trees[stored:]), data.schema)), r
        tree = Tree()
        live = [tree.add(0.0)]
        for level in range(depth):
            ddl = "node long, f long, b long, g long, h long"
            cells = data.mapInArrow(_cells(model.trees[stored:], tree, live, unit), ddl) \
                .groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()  # at most nodes x features x bins rows
            found = best_splits(cells, live, unit, l2, gamma, min_child)
            if level == 0 and found[0] is None:  # no split at all: the root is a leaf
                root = cells[cells["f"] == cells["f"].min()]
                tree.weight[0] = eta * -(int(root["g"].sum()) * unit / (int(root["h"].sum()) + l2)) if len(root) else 0.0
            nxt = []
            for node, s in zip(live, found, strict=True):
                if s is None:
                    continue
                _, tree.feature[node], tree.cut[node], tree.missing_left[node] = s[:4]
                tree.child[node] = tree.add(eta * -(s[4][0] / (s[4][1] + l2)))
                tree.add(eta * -(s[5][0] / (s[5][1] + l2)))
                nxt += [tree.child[node], tree.child[node] + 1]
            live = nxt
            if not live:
                break
        model.trees.append(tree)
    return model
