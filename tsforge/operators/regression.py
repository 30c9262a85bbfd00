"""Least squares per series from Gram sums (T1 ADF; reused by the AR and VAR fits).

Rows never leave their partitions: each Arrow batch is reduced to X'X per series
(``mapInPandas``), the partial matrices are summed by a grouped aggregation (map-side
combine, so a series spread over many tasks costs one partial matrix per task), and only
the summed k x k matrix of a series reaches the small solve in ``applyInPandas``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions import solvers
from tsforge.operators import segments as sg
from tsforge.operators.features import windowed
from tsforge.session import reuse_input


def _partial_gram(keys: list[str], cols: list[str]):
    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = pdf[cols].to_numpy(dtype=float, na_value=0.0)
            x = np.nan_to_num(x)
            for grp, idx in pdf.groupby(keys, sort=False).indices.items():
                xs = x[idx]
                g = xs.T @ xs
                grp = grp if isinstance(grp, tuple) else (grp,)
                yield pd.DataFrame([list(grp) + [g.ravel().tolist()]], columns=keys + ["_g"])
    return run


def gram(df: DataFrame, cols: list[str], keys=("series_id",)) -> DataFrame:
    """Long-form Gram sums ``keys, idx, val`` with ``val = sum x_a x_b`` and idx = a*k + b.

    Nulls count as 0 (callers put a 0/1 indicator column first when they need counts)."""
    keys = list(keys)
    fields = [df.schema[k] for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] +
                          [T.StructField("_g", T.ArrayType(T.DoubleType()))])
    # rows of a series kept together, so an Arrow batch yields few partial matrices (the windowed
    # inputs are already clustered this way and the sort is then a no-op for the planner)
    part = (df.select(*keys, *[F.col(c).cast("double") for c in cols]).sortWithinPartitions(*keys)
              .mapInPandas(_partial_gram(keys, cols), schema))
    return (part.select(*keys, F.posexplode("_g").alias("idx", "val"))
                .groupBy(*keys, "idx").agg(F.sum("val").alias("val")))


def adf_max_lag(n: int) -> int:
    """Schwert's rule ceil(12 (n/100)^(1/4)), at most n//2 - 2 (constant-only regression)."""
    return min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2)


ADF_BLOCK = 8192  # rows of the regressor matrix built at a time


def _adf_segment(pdf: pd.DataFrame) -> pd.DataFrame:
    """Upper triangle of X'X over one segment's common-sample rows, with the series' own lag
    count, and the few rows before the common sample as they are."""
    pdf = pdf.sort_values(sg.POS)
    sid, p = pdf["series_id"].iloc[0], int(pdf["_pmax"].iloc[0])
    x, pos, home = pdf["_x"].to_numpy(float), pdf[sg.POS].to_numpy(), pdf[sg.HOME].to_numpy()
    dx = np.diff(x, prepend=np.nan)
    if pos[0] > 1:
        dx[0] = np.nan  # the row before is not in the segment's reach
    k = p + 3  # 1, x_{t-1}, dx_{t-1..t-p}, dx_t
    at = np.flatnonzero(home & (pos - 1 >= p + 1))
    g = np.zeros((k, k))
    for lo in range(0, len(at), ADF_BLOCK):
        t = at[lo:lo + ADF_BLOCK]
        m = np.empty((len(t), k))
        m[:, 0], m[:, 1], m[:, -1] = 1.0, x[t - 1], dx[t]
        for i in range(1, p + 1):
            m[:, i + 1] = dx[t - i]
        g += m.T @ m
    rows = [(sid, 0, -1, g[np.triu_indices(k)].tolist())] if len(at) else []
    for t in np.flatnonzero(home & (pos >= 2) & (pos - 1 < p + 1)):
        v = np.zeros(k)
        v[0], v[1], v[-1] = 1.0, x[t - 1], dx[t]
        for i in range(1, p + 1):
            if pos[t] - i >= 2:
                v[i + 1] = dx[t - i]
        rows.append((sid, 1, int(pos[t] - 1), v.tolist()))
    return pd.DataFrame(rows, columns=["series_id", "kind", "j", "vec"])


def _adf_solve(pdf: pd.DataFrame) -> pd.DataFrame:
    names = ["series_id", "n", "adf_stat", "adf_pvalue", "used_lag", "nobs"]
    sid, n, pmax = pdf["series_id"].iloc[0], int(pdf["_n"].iloc[0]), int(pdf["_pmax"].iloc[0])
    none = pd.DataFrame([(sid, n, None, None, None, None)], columns=names)
    d = pmax + 3
    sums = pdf[pdf["kind"] == 0]
    if pmax < 0 or sums.empty:
        return none
    g = np.zeros((d, d))
    upper = np.triu_indices(d)
    g[upper] = np.asarray(sums["vec"].iloc[0], float)
    g = g + np.triu(g, 1).T
    yi = d - 1
    nobs_c = g[0, 0]
    if nobs_c < 3 or g[1, 1] <= 0:  # too short, or constant: x_{t-1} is all zero after scaling
        return none
    best, best_p = None, 0
    for p in range(pmax + 1):
        cols = list(range(2 + p))
        _, ssr, _ = solvers.ols_from_gram(g[np.ix_(cols, cols)], g[cols, yi], g[yi, yi])
        aic = nobs_c * (math.log(2 * math.pi) + math.log(max(ssr, 1e-300) / nobs_c) + 1) + 2 * len(cols)
        if best is None or aic < best:
            best, best_p = aic, p
    p = best_p
    cols = list(range(2 + p)) + [yi]
    gp = g[np.ix_(cols, cols)].copy()
    heads = pdf[(pdf["kind"] == 1) & (pdf["j"] >= p + 1)]
    for vec in heads["vec"]:
        v = np.asarray(vec, float)[cols]
        gp += np.outer(v, v)
    k = len(cols) - 1
    beta, ssr, inv = solvers.ols_from_gram(gp[:k, :k], gp[:k, k], gp[k, k])
    nobs = gp[0, 0]
    s2 = ssr / (nobs - k) if nobs > k else float("nan")
    se = math.sqrt(s2 * inv[1, 1]) if s2 == s2 and inv[1, 1] > 0 else float("nan")
    tau = beta[1] / se if se and se == se else float("nan")
    if not math.isfinite(tau):
        return none
    return pd.DataFrame([(sid, n, float(tau), solvers.mackinnon_p(tau), int(p), int(round(nobs)))], columns=names)


ADF_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("adf_stat", T.DoubleType()), T.StructField("adf_pvalue", T.DoubleType()),
    T.StructField("used_lag", T.IntegerType()), T.StructField("nobs", T.LongType()),
])


def adf(df: DataFrame, value: str = "close", key: str = "series_id", ts: str = "ts", **kw) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, lag chosen by AIC.

    Lags 0..pmax (Schwert's rule) are compared on the common sample; the chosen lag is
    refitted on its longer sample (common Gram plus the few head rows). Statistic = t of
    x_{t-1}; p-value from MacKinnon (1994). Values are standardised per series first, which
    leaves the statistic and the lag choice unchanged and keeps the Gram well conditioned. Each
    series carries only its own pmax lags; a series too short or constant has a null statistic."""
    if key != "series_id":
        df = df.withColumnRenamed(key, "series_id")
    base = reuse_input(sg.home_rows(df).select("series_id", ts, value).filter(F.col(value).isNotNull()))
    st = base.groupBy("series_id").agg(F.count(F.lit(1)).alias("_n"), F.avg(value).alias("_mu"),
                                       F.when(F.min(value) == F.max(value), 0.0).otherwise(F.stddev_pop(value)).alias("_sd"))
    pmax_col = F.least(F.ceil(12.0 * F.pow(F.col("_n") / 100.0, 0.25)), F.floor(F.col("_n") / 2) - 2).cast("int")
    st = sg._maybe_broadcast(st.withColumn("_pmax", pmax_col))
    constant = F.col("_sd") == 0
    z = base.join(st, "series_id").withColumn(
        "_x", F.when(constant, 0.0).otherwise(F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd")))).where("_pmax >= 0")
    d = sg.with_positions(z.select("series_id", ts, "_x", "_pmax"), "series_id", ts, kw.get("unit", "auto"))
    d = sg.segmented(d.withColumn("_reach", F.col("_pmax") + 2), before="_reach", size=kw.get("size", sg.DEFAULT_SEGMENT_ROWS))
    rows = reuse_input(d.select("series_id", sg.SEG, sg.POS, sg.HOME, "_x", "_pmax").groupBy("series_id", sg.SEG).applyInPandas(
        _adf_segment, "series_id string, kind int, j int, vec array<double>"))
    gram_sum = rows.where("kind = 0").select("series_id", F.posexplode("vec").alias("i", "v")).groupBy("series_id", "i").agg(F.sum("v").alias("v")) \
        .groupBy("series_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("vec"))
    parts = rows.where("kind = 1").unionByName(gram_sum.select("series_id", F.lit(0).alias("kind"), F.lit(-1).alias("j"), "vec"))
    # one marker row per series, so series too short for any regression still get a (null) result
    marks = st.select("series_id", F.lit(2).alias("kind"), F.lit(-1).alias("j"), F.lit(None).cast("array<double>").alias("vec"))
    meta = st.select("series_id", F.col("_n").cast("bigint"), "_pmax")
    out = parts.unionByName(marks).join(meta, "series_id").groupBy("series_id").applyInPandas(_adf_solve, ADF_SCHEMA)
    return out if key == "series_id" else out.withColumnRenamed("series_id", key)
