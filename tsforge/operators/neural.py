"""Data-parallel dense network on lag windows.

Synchronous parameter averaging: every epoch the driver broadcasts the weights, each
partition scores its validation rows with them, runs one local pass of mini-batch Adam over its
training rows (``mapInPandas``), and the row-weighted weights and losses of all partitions are summed
on the executors. One vector of the network's size reaches the driver each epoch, whatever the
number of partitions; the rows never do.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def init_weights(n_in: int, hidden: tuple[int, ...], seed: int = 42) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    sizes = [n_in, *hidden, 1]
    ws = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        lim = np.sqrt(6.0 / (a + b))
        ws += [rng.uniform(-lim, lim, size=(a, b)), np.zeros(b)]
    return ws


def forward(ws: list[np.ndarray], x: np.ndarray, drop: float = 0.0, rng=None):
    acts = [x]
    h = x
    for i in range(0, len(ws) - 2, 2):
        h = np.maximum(h @ ws[i] + ws[i + 1], 0.0)
        if drop and rng is not None:
            h = h * (rng.random(h.shape) >= drop) / (1.0 - drop)
        acts.append(h)
    out = h @ ws[-2] + ws[-1]
    return out[:, 0], acts


def _grads(ws, x, y, drop, rng):
    pred, acts = forward(ws, x, drop, rng)
    err = pred - y
    g = [None] * len(ws)
    delta = (2.0 / len(y)) * err[:, None]
    for i in range(len(ws) - 2, -1, -2):
        a = acts[i // 2]
        g[i] = a.T @ delta
        g[i + 1] = delta.sum(0)
        if i > 0:  # units that were dropped or at rest pass nothing; the others were scaled up
            delta = (delta @ ws[i].T) * (acts[i // 2] > 0) / (1.0 - (drop if rng is not None else 0.0))
    return g, float((err ** 2).mean()), float(np.abs(err).mean())


def _pack(ws):
    return np.concatenate([w.ravel() for w in ws])


def _unpack(flat, shapes):
    out, i = [], 0
    for s in shapes:
        n = int(np.prod(s))
        out.append(np.asarray(flat[i:i + n]).reshape(s))
        i += n
    return out


N_STATS = 6  # training rows, their loss and error sums; validation rows, squared and absolute error sums


CHUNK = 4096  # numbers of a partition's vector that travel as one row
_PARTS = "trial int, chunk int, pid int, v binary"


class _Local:
    """One trial's epoch in one partition: Adam from the weights sent, and the sums of ``N_STATS`` numbers."""

    def __init__(self, start: list[np.ndarray], lr: float, batch: int, drop: float, seed: int, fit: bool):
        self.start, self.lr, self.batch, self.drop, self.seed, self.fit = start, lr, batch, drop, seed, fit
        self.ws = [w.copy() for w in start]
        self.m, self.v = [np.zeros_like(w) for w in start], [np.zeros_like(w) for w in start]
        self.step, self.stats = 0, np.zeros(N_STATS)

    def score(self, x, y) -> None:
        e = forward(self.start, x)[0] - y
        self.stats[3:] += len(y), float((e ** 2).sum()), float(np.abs(e).sum())

    def train(self, x, y, pid: int) -> None:
        ws, m, v = self.ws, self.m, self.v
        rng = np.random.default_rng(self.seed + pid)
        order = rng.permutation(len(y))
        for s in range(0, len(y), self.batch):
            idx = order[s:s + self.batch]
            g, l2, l1 = _grads(ws, x[idx], y[idx], self.drop, rng)
            self.step += 1
            for k in range(len(ws)):
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                mh = m[k] / (1 - 0.9 ** self.step)
                vh = v[k] / (1 - 0.999 ** self.step)
                ws[k] = ws[k] - self.lr * mh / (np.sqrt(vh) + 1e-7)
            self.stats[:3] += len(idx), l2 * len(idx), l1 * len(idx)

    def vector(self) -> np.ndarray:
        return np.concatenate([self.stats, _pack(self.ws) * self.stats[0]]) if self.fit else self.stats


def _local_epochs(bc, plan: list[tuple]):
    """One partition's epoch of every trial of ``plan`` (trial, shapes, lr, batch, dropout, seed, fit),
    side by side in one pass over the rows; ``bc`` holds their weights."""
    def run(batches):
        each = {t: _Local(_unpack(bc.value[t], shapes), *rest) for t, shapes, *rest in plan}
        pid = 0
        for pdf in batches:
            if pdf.empty:
                continue
            pid = int(pdf["_pid"].iloc[0])
            x, y = np.stack(pdf["x"].to_numpy()).astype(float), pdf["label"].to_numpy(dtype=float)
            valid, train = (pdf["split"] == "valid").to_numpy(), (pdf["split"] == "train").to_numpy()
            for t in each.values():
                if valid.any():
                    t.score(x[valid], y[valid])
                if t.fit and train.any():
                    t.train(x[train], y[train], pid)
        rows = []
        for t, e in each.items():
            if e.stats.any():
                v = e.vector()
                rows += [(t, k, pid, v[k * CHUNK:(k + 1) * CHUNK].tobytes()) for k in range(-(-len(v) // CHUNK))]
        if rows:
            yield pd.DataFrame(rows, columns=["trial", "chunk", "pid", "v"])
    return run


def _add_up(t: pa.Table) -> pa.Table:
    """Sum of a chunk's vectors, in the order of the partitions."""
    t = t.sort_by("pid")
    total = np.sum([np.frombuffer(v.as_buffer(), float) for v in t.column("v")], axis=0)
    return pa.table({"trial": t.column("trial").slice(0, 1), "chunk": t.column("chunk").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})


def _sum_vectors(parts: DataFrame) -> dict[int, np.ndarray]:
    """Elementwise sum of the partitions' vectors of each trial, added up on the executors: one vector
    of its size for each trial comes back."""
    got = parts.groupBy("trial", "chunk").applyInArrow(lambda t: _add_up(t), "trial int, chunk int, v binary").toPandas().sort_values(["trial", "chunk"])
    return {int(t): np.concatenate([np.frombuffer(v, float) for v in g["v"]]) for t, g in got.groupby("trial")}


class MLPResult:
    def __init__(self, weights, shapes, history: list[tuple], best: float | None = None):
        self.weights, self.shapes, self.history, self.best = weights, shapes, history, best

    def history_df(self, spark) -> DataFrame:
        """M7: one row per epoch and split."""
        return spark.createDataFrame(self.history, "epoch int, split string, loss double, mae double, lr double")


def train_mlp(ds: DataFrame, hidden: tuple[int, ...] = (32,), epochs: int = 15, lr: float = 1e-2, batch: int = 8,
              dropout: float = 0.0, partitions: int | None = None, patience: int = 5, lr_patience: int = 5,
              lr_factor: float = 0.5, min_lr: float = 1e-6, seed: int = 42, chunk: str = "month") -> MLPResult:
    """F7/F8 training loop with M5 (early stopping on validation loss, best weights kept),
    M6 (learning rate halved after ``lr_patience`` epochs without improvement, floor
    ``min_lr``) and M7 (history). ``ds`` has ``features`` (vector), ``label`` and ``split``.

    Rows are hash-partitioned by (series, time chunk) into ``partitions`` parts (default: the
    cluster's parallelism), so one long series is spread over many workers; a given count and an
    in-partition sort make runs repeatable. An epoch is one job: it scores the validation rows
    with the weights it starts from and trains on the others."""
    return train_many(ds, [{"hidden": hidden, "lr": lr, "dropout": dropout}], epochs, batch, partitions, patience, lr_patience,
                      lr_factor, min_lr, seed, chunk)[0]


class _Trial:
    """What the driver keeps of one network in training."""

    def __init__(self, n_in: int, hidden, lr: float, dropout: float, seed: int):
        ws = init_weights(n_in, tuple(hidden), seed)
        self.shapes, self.flat = [w.shape for w in ws], _pack(ws)
        self.lr, self.dropout = lr, dropout
        self.best, self.best_w, self.bad, self.bad_lr = None, self.flat, 0, 0
        self.history, self.loss, self.live = [], None, True

    def step(self, ep: int, tot: np.ndarray, fit: bool, patience: int, lr_patience: int, lr_factor: float, min_lr: float) -> None:
        n, nv = tot[0], tot[3]
        if ep > 1:  # what the weights of the epoch before score
            vl = tot[4] / nv if nv else self.loss
            if nv:
                self.history.append((ep - 1, "valid", float(vl), float(tot[5] / nv), float(self.lr)))
            if self.best is None or vl < self.best - 1e-12:
                self.best, self.best_w, self.bad, self.bad_lr = vl, self.flat, 0, 0
            else:
                self.bad += 1
                self.bad_lr += 1
                if self.bad_lr >= lr_patience:
                    self.lr, self.bad_lr = max(self.lr * lr_factor, min_lr), 0
                if self.bad >= patience:
                    self.live = False
                    return
        if fit and n:
            self.flat = tot[N_STATS:] / n
            self.loss = tot[1] / n
            self.history.append((ep, "train", float(self.loss), float(tot[2] / n), float(self.lr)))


def train_many(ds: DataFrame, configs: list[dict], epochs: int = 15, batch: int = 8, partitions: int | None = None, patience: int = 5,
               lr_patience: int = 5, lr_factor: float = 0.5, min_lr: float = 1e-6, seed: int = 42, chunk: str = "month") -> list[MLPResult]:
    """``train_mlp`` for several networks (``hidden``, ``lr``, ``dropout``) at once: an epoch of all that
    have not stopped is one job and one pass over the rows, so a search takes as many jobs as its
    longest trial."""
    spark = ds.sparkSession
    parts_n = partitions or spark.sparkContext.defaultParallelism
    d = ds.select(vector_to_array("features").alias("x"), "label", "split", "series_id", "ts").where("split <> 'test'")
    rows = (d.repartition(parts_n, "series_id", F.date_trunc(chunk, F.col("ts").cast("timestamp")))
             .sortWithinPartitions("series_id", "ts").withColumn("_pid", F.spark_partition_id()).cache())
    sc = spark.sparkContext
    try:
        n_in = len(rows.select("x").first()["x"])
        trials = [_Trial(n_in, c["hidden"], c["lr"], c.get("dropout", 0.0), seed) for c in configs]
        for ep in range(1, epochs + 2):  # the last round only scores the last weights
            live = {i: t for i, t in enumerate(trials) if t.live}
            if not live:
                break
            fit = ep <= epochs
            bc = sc.broadcast({i: t.flat for i, t in live.items()})
            plan = [(i, t.shapes, t.lr, batch, t.dropout, seed * 1000 + ep, fit) for i, t in live.items()]
            got = _sum_vectors(rows.mapInPandas(_local_epochs(bc, plan), _PARTS))
            bc.unpersist()
            for i, t in live.items():
                t.step(ep, got.get(i, np.zeros(N_STATS)), fit, patience, lr_patience, lr_factor, min_lr)
    finally:
        rows.unpersist()
    return [MLPResult(_unpack(t.best_w, t.shapes), t.shapes, t.history, t.best) for t in trials]


# The search space of the dense-network script.
NET_SPACE = {"units_input": list(range(32, 257, 32)), "dropout": [0.1, 0.2, 0.3, 0.4, 0.5], "num_layers": [1, 2, 3],
             "units": list(range(32, 129, 32)), "lr": (1e-4, 1e-2)}


def sample_networks(n: int, space: dict | None = None, seed: int = 42) -> list[dict]:
    """``n`` random configurations: widths, dropout and depth from lists, the rate log-uniform."""
    space, rng, out = space or NET_SPACE, random.Random(seed), []
    for _ in range(n):
        lo, hi = space["lr"]
        hidden = [rng.choice(space["units_input"])] + [rng.choice(space["units"]) for _ in range(rng.choice(space["num_layers"]))]
        out.append({"hidden": tuple(hidden), "dropout": rng.choice(space["dropout"]), "lr": float(lo * (hi / lo) ** rng.random())})
    return out


def search_networks(ds: DataFrame, trials: int = 10, epochs: int = 50, batch: int = 32, space: dict | None = None,
                    seed: int = 42, **kw) -> tuple[DataFrame, MLPResult]:
    """M3 + M4: random search over the network by validation loss, with early stopping of each trial.
    All trials run side by side in one pass over the rows for each epoch. Returns one row for each
    trial and the best network."""
    maps = sample_networks(trials, space, seed)
    made = train_many(ds, maps, epochs, batch, seed=seed, **kw)
    losses = [r.best for r in made]
    best = min(range(trials), key=lambda i: (losses[i] if losses[i] is not None else float("inf"), i))
    rows = [(i, list(m["hidden"]), float(m["dropout"]), m["lr"], None if losses[i] is None else float(losses[i]), i == best) for i, m in enumerate(maps)]
    table = ds.sparkSession.createDataFrame(rows, "trial int, hidden array<int>, dropout double, lr double, valid_loss double, best boolean")
    return table, made[best]


def predict(res: MLPResult, ds: DataFrame) -> DataFrame:
    """score with broadcast weights in an Arrow-batched pandas UDF."""
    spark = ds.sparkSession
    bc = spark.sparkContext.broadcast(_pack(res.weights))
    shapes = res.shapes

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        ws = _unpack(bc.value, shapes)
        p, _ = forward(ws, np.stack(x.to_numpy()).astype(float))
        return pd.Series(p)

    return ds.withColumn("prediction", score(vector_to_array("features")))


def mlp_forecasts(res: MLPResult, ds: DataFrame, name: str = "mlp") -> DataFrame:
    pred = predict(res, ds.filter("split = 'test'"))
    f = F.col("prediction") * (F.col("vmax") - F.col("vmin")) + F.col("vmin")
    return pred.select("series_id", F.lit(name).alias("model"), "ts", F.lit(None).cast("int").alias("horizon"),
                       "actual", f.alias("forecast"))
