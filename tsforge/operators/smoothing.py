"""Recursive forecasters fitted by grid search with an exact segmented scan (F2 Holt, F3 GARCH).

Both recursions are linear in their state for fixed parameters, so a segment of a series
can be summarised without knowing the state it starts from:

* Holt: the state s = (level, trend) evolves as s_t = A s_{t-1} + c x_t. Over a segment the
  one-step errors are affine in the entering state, so the segment's SSE is a quadratic form
  of it, and the leaving state is an affine map of it. These summaries compose associatively,
  so a series' summaries are reduced as a tree (``tree_reduce``, bounded fan-in) to the exact
  SSE as a quadratic in the initial state, which is then minimised in closed form (the
  "estimated" initial level and trend) for every (alpha, beta) candidate.
* GARCH(1,1): the variance follows sigma2_t = beta sigma2_{t-1} + omega + alpha eps2_{t-1}.
  Pass 1 summarises each segment as sigma2_out = beta^m sigma2_in + v; a short lag chain over
  the segment table (full segments multiply the entering variance by beta^size, i.e. 0) gives
  every segment's entering variance; pass 2 adds up the Gaussian log-likelihood.

Every Python step sees one bounded segment or at most ``fan_in`` summaries, and all
candidates are evaluated together as numpy vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.operators import segments as sg
from tsforge.operators.features import windowed
from tsforge.session import materialize, reuse_input

ARR = T.ArrayType(T.DoubleType())


def _holt_grid(ca: float | None, cb: float | None) -> tuple[np.ndarray, np.ndarray]:
    if ca is None or ca != ca:
        g = np.round(np.arange(0.05, 0.951, 0.05), 10)
        a, b = np.meshgrid(g, g, indexing="ij")
    else:
        ga = np.clip(np.round(np.arange(ca - 0.05, ca + 0.0501, 0.005), 10), 0.001, 0.999)
        gb = np.clip(np.round(np.arange(cb - 0.05, cb + 0.0501, 0.005), 10), 0.001, 0.999)
        a, b = np.meshgrid(ga, gb, indexing="ij")
    return a.ravel(), b.ravel()


HOLT_SEG_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()), T.StructField("_seg", T.LongType()), T.StructField("m", T.LongType()),
    T.StructField("alpha", ARR), T.StructField("beta", ARR),
    *[T.StructField(k, ARR) for k in ("M11", "M12", "M21", "M22", "u1", "u2", "saa", "sa1", "sa2", "s11", "s12", "s22")],
])


def _holt_segment(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(sg.POS)
    x = pdf["_x"].to_numpy(dtype=float)
    al, be = _holt_grid(pdf["_ca"].iloc[0], pdf["_cb"].iloc[0])
    a11 = 1 - al
    a12 = 1 - al
    a21 = -al * be
    a22 = 1 - al * be
    c1, c2 = al, al * be
    z = np.zeros_like(al)
    u1, u2 = z.copy(), z.copy()
    p11, p12, p21, p22 = np.ones_like(al), z.copy(), z.copy(), np.ones_like(al)
    saa, sa1, sa2, s11, s12, s22 = (z.copy() for _ in range(6))
    for xt in x:
        g1, g2 = p11 + p21, p12 + p22
        a = xt - (u1 + u2)
        saa += a * a
        sa1 += a * g1
        sa2 += a * g2
        s11 += g1 * g1
        s12 += g1 * g2
        s22 += g2 * g2
        u1, u2 = a11 * u1 + a12 * u2 + c1 * xt, a21 * u1 + a22 * u2 + c2 * xt
        p11, p12, p21, p22 = a11 * p11 + a12 * p21, a11 * p12 + a12 * p22, a21 * p11 + a22 * p21, a21 * p12 + a22 * p22
    vals = [p11, p12, p21, p22, u1, u2, saa, sa1, sa2, s11, s12, s22]
    return pd.DataFrame([[pdf["series_id"].iloc[0], int(pdf["_seg"].iloc[0]), len(x), al, be] + vals],
                        columns=[f.name for f in HOLT_SEG_SCHEMA.fields])


HOLT_FIT_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("alpha", T.DoubleType()), T.StructField("beta", T.DoubleType()),
    T.StructField("level0", T.DoubleType()), T.StructField("trend0", T.DoubleType()),
    T.StructField("level", T.DoubleType()), T.StructField("trend", T.DoubleType()), T.StructField("sse", T.DoubleType()),
])

_SUMMARY = ("M11", "M12", "M21", "M22", "u1", "u2", "saa", "sa1", "sa2", "s11", "s12", "s22")


def _mat(r, a, b, c, d):
    return np.stack([np.stack([np.asarray(r[a]), np.asarray(r[b])], -1), np.stack([np.asarray(r[c]), np.asarray(r[d])], -1)], -2)


def _holt_merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Compose ordered segment summaries into one (associative): for A then B,
    M = M_B M_A, u = M_B u_A + u_B, and SSE_B evaluated at the state leaving A."""
    pdf = pdf.sort_values("_seg")
    rows = pdf.to_dict("records")
    acc = None
    for r in rows:
        M, u = _mat(r, "M11", "M12", "M21", "M22"), np.stack([np.asarray(r["u1"]), np.asarray(r["u2"])], -1)
        G, w = _mat(r, "s11", "s12", "s12", "s22"), np.stack([np.asarray(r["sa1"]), np.asarray(r["sa2"])], -1)
        saa = np.asarray(r["saa"])
        if acc is None:
            acc = [M, u, saa, w, G]
            continue
        Ma, ua, sa, wa, Ga = acc
        Gu = np.einsum("gij,gj->gi", G, ua)
        acc = [np.einsum("gij,gjk->gik", M, Ma), np.einsum("gij,gj->gi", M, ua) + u,
               sa + saa - 2 * np.einsum("gi,gi->g", w, ua) + np.einsum("gi,gi->g", ua, Gu),
               wa + np.einsum("gji,gj->gi", Ma, w - Gu),
               Ga + np.einsum("gki,gkl,glj->gij", Ma, G, Ma)]
    M, u, saa, w, G = acc
    first = rows[0]
    return pd.DataFrame([[first["series_id"], int(first["_grp"]), int(pdf["m"].sum()), first["alpha"], first["beta"],
                          M[:, 0, 0], M[:, 0, 1], M[:, 1, 0], M[:, 1, 1], u[:, 0], u[:, 1], saa, w[:, 0], w[:, 1],
                          G[:, 0, 0], G[:, 0, 1], G[:, 1, 1]]],
                        columns=["series_id", "_seg", "m", "alpha", "beta", *_SUMMARY])


def _holt_finish(pdf: pd.DataFrame) -> pd.DataFrame:
    """Best candidate of one series from its single whole-series summary: the initial state
    minimising saa - 2 w's + s'Gs is G^-1 w."""
    r = pdf.iloc[0]
    G, w = _mat(r, "s11", "s12", "s12", "s22"), np.stack([np.asarray(r["sa1"]), np.asarray(r["sa2"])], -1)
    M, u = _mat(r, "M11", "M12", "M21", "M22"), np.stack([np.asarray(r["u1"]), np.asarray(r["u2"])], -1)
    Gr = G + 1e-12 * np.abs(G).max() * np.eye(2)
    s0 = np.linalg.solve(Gr, w[..., None])[..., 0]
    sse = np.asarray(r["saa"]) - np.einsum("gi,gi->g", w, s0)
    if not np.isfinite(sse).any():
        return pd.DataFrame([[r["series_id"], int(r["m"]), *[np.nan] * 7]], columns=[f.name for f in HOLT_FIT_SCHEMA.fields])
    best = int(np.nanargmin(np.where(np.isfinite(sse), sse, np.nan)))
    fin = M[best] @ s0[best] + u[best]
    return pd.DataFrame([[r["series_id"], int(r["m"]), float(r["alpha"][best]), float(r["beta"][best]), float(s0[best, 0]),
                          float(s0[best, 1]), float(fin[0]), float(fin[1]), float(sse[best])]],
                        columns=[f.name for f in HOLT_FIT_SCHEMA.fields])


def tree_reduce(parts: DataFrame, merge, schema: T.StructType, fan_in: int = 256) -> DataFrame:
    """Reduce ordered per-segment summaries (``series_id, _seg, ...``) to one row per series
    with an associative ``merge``, ``fan_in`` summaries per group and level, so no group
    ever holds more than ``fan_in`` summaries whatever the series length."""
    parts = parts.cache()
    top = parts.agg(F.max("_seg")).first()[0] or 0
    while True:
        parts = parts.withColumn("_grp", F.floor(F.col("_seg") / fan_in).cast("bigint"))
        parts = parts.groupBy("series_id", "_grp").applyInPandas(merge, schema)
        if top < fan_in:
            return parts
        top //= fan_in


def _training_rows(df: DataFrame, value: str, key: str, ts: str, size: int, unit: str, centre: str = "mean") -> DataFrame:
    """Positions, segment numbers and the value shifted by a per-series constant ``_c`` (the
    mean, or the first value). Holt's recursion is shift-equivariant, so fitting the shifted
    values changes no error and keeps the summaries well conditioned."""
    base = df.select(key, ts, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    d = sg.with_positions(base, key, ts, unit)  # writes ``base`` once if it is costly to recompute
    agg = F.avg("_x") if centre == "mean" else F.min_by("_x", sg.POS)
    c = sg._maybe_broadcast(d.groupBy(key).agg(agg.alias("_c")))
    d = d.join(c, key).withColumn("_x", F.col("_x") - F.col("_c"))
    return d.withColumn("_seg", F.floor((F.col(sg.POS) - 1) / size).cast("bigint"))


def holt_fit(df: DataFrame, value: str = "close", key: str = "series_id", ts: str = "ts",
             size: int = sg.DEFAULT_SEGMENT_ROWS, unit: str = "auto", fan_in: int = 256) -> DataFrame:
    """F2 fit: Holt's linear trend method, (alpha, beta) by a 0.05 grid refined to 0.005 around
    the best point, initial level/trend by exact least squares. One row per series."""
    if key != "series_id":
        df = df.withColumnRenamed(key, "series_id")
    rows = _training_rows(df, value, "series_id", ts, size, unit).cache()
    coarse = rows.withColumn("_ca", F.lit(None).cast("double")).withColumn("_cb", F.lit(None).cast("double"))

    def fit(r):
        seg = r.groupBy("series_id", "_seg").applyInPandas(_holt_segment, HOLT_SEG_SCHEMA)
        red = tree_reduce(seg, _holt_merge, HOLT_SEG_SCHEMA, fan_in)
        return red.groupBy("series_id").applyInPandas(_holt_finish, HOLT_FIT_SCHEMA)

    fit1 = fit(coarse)
    centre = sg._maybe_broadcast(fit1.select("series_id", F.col("alpha").alias("_ca"), F.col("beta").alias("_cb")))
    out = fit(rows.join(centre, "series_id"))
    shift = rows.groupBy("series_id").agg(F.first("_c").alias("_c"))
    return out.join(shift, "series_id").withColumns({"level0": F.col("level0") + F.col("_c"),
                                                    "level": F.col("level") + F.col("_c")}).drop("_c")


def holt_sse_grid(df: DataFrame, value: str = "close", key: str = "series_id", ts: str = "ts",
                  size: int = sg.DEFAULT_SEGMENT_ROWS, unit: str = "auto", fan_in: int = 256) -> DataFrame:
    """SSE of Holt's one-step errors for every (alpha, beta) of the coarse 0.05 grid, started
    from level = first value and trend = 0 (values shifted by the first value, so the start
    state is zero and the SSE is the summary's constant term). One row per series and point."""
    if key != "series_id":
        df = df.withColumnRenamed(key, "series_id")
    rows = _training_rows(df, value, "series_id", ts, size, unit, centre="first")
    coarse = rows.withColumn("_ca", F.lit(None).cast("double")).withColumn("_cb", F.lit(None).cast("double"))
    seg = coarse.groupBy("series_id", "_seg").applyInPandas(_holt_segment, HOLT_SEG_SCHEMA)
    red = tree_reduce(seg, _holt_merge, HOLT_SEG_SCHEMA, fan_in)
    z = red.select("series_id", "m", F.explode(F.arrays_zip("alpha", "beta", "saa")).alias("_z"))
    return z.select("series_id", F.col("m").alias("n"), F.col("_z.alpha").alias("alpha"), F.col("_z.beta").alias("beta"),
                    F.col("_z.saa").alias("sse"))


def holt_forecast(fit: DataFrame, horizon: int = 30) -> DataFrame:
    """F2 forecast: level + h * trend for h = 1..horizon (long form)."""
    return fit.select("series_id", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"), "level", "trend").select(
        "series_id", F.col("horizon").cast("int"), (F.col("level") + F.col("horizon") * F.col("trend")).alias("forecast"))


# ---- GARCH(1,1) --------------------------------------------------------------------------------------

GARCH_FINE = 0.005


def _garch_grid(ca: float | None = None, cb: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (alpha, beta): a 0.05 grid over alpha > 0, beta >= 0, alpha + beta < 1, or, around
    a coarse best point, a 0.005 grid one coarse step to each side."""
    if ca is None or not np.isfinite(ca):
        x = np.round(np.concatenate([[0.01], np.arange(0.05, 0.951, 0.05)]), 10)
        y = np.round(np.concatenate([np.arange(0.0, 0.951, 0.05), [0.98]]), 10)
    else:
        step = np.arange(-10, 11) * GARCH_FINE
        x, y = np.round(np.maximum(ca + step, GARCH_FINE), 10), np.round(np.maximum(cb + step, 0.0), 10)
    a, b = np.meshgrid(np.unique(x), np.unique(y), indexing="ij")
    a, b = a.ravel(), b.ravel()
    keep = a + b < GARCH_MAX_BETA + 5e-4
    return a[keep], b[keep]


def _garch_own_grid(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _garch_grid(pdf["_ca"].iloc[0], pdf["_cb"].iloc[0])


GARCH_MAX_BETA = 0.999
GARCH_MIN_RETURNS = 10


GARCH_A_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("_seg", T.LongType()),
                               T.StructField("mult", ARR), T.StructField("v", ARR)])


def _garch_pass_a(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per segment: variance leaving the segment = mult * variance entering + v (per candidate)."""
    pdf = pdf.sort_values(sg.POS)
    al, be = _garch_own_grid(pdf)
    s2 = float(pdf["_s2"].iloc[0])
    om = s2 * (1 - al - be)
    y = np.zeros_like(al)
    mult = np.ones_like(al)
    for first, ep in zip(pdf["_first"].to_numpy(), pdf["_ep2"].to_numpy(dtype=float, na_value=np.nan)):
        if first:  # the series' first return: sigma2 = s2 whatever came before
            y = np.full_like(al, s2)
            mult = np.zeros_like(al)
        else:
            y = be * y + om + al * ep
            mult = be * mult
    return pd.DataFrame([[pdf["series_id"].iloc[0], int(pdf["_seg"].iloc[0]), mult, y]],
                        columns=["series_id", "_seg", "mult", "v"])


def garch_chain_depth(size: int) -> int:
    """Segments a variance must be carried back so that the dropped remainder, multiplied by
    beta^(rows) <= 0.999^(depth * size), is below 1e-20 relative."""
    return int(math.ceil(20.0 / (size * -math.log10(GARCH_MAX_BETA)))) + 1


def _garch_chain(seg: DataFrame, depth: int) -> DataFrame:
    """Entering variance of every segment and candidate:
    y_in(k) = sum_{d=1..depth} (prod_{i<d} mult_{k-i}) v_{k-d}. Full segments multiply the
    entering variance by beta^size, so ``depth`` segments are exact to double precision; the
    per-segment table is itself laid out in bounded segments (positions = segment numbers)."""
    t = seg.withColumnRenamed("_seg", "_gseg").withColumn(sg.POS, F.col("_gseg") + 1)
    lay = sg.segmented(t, before=depth, size=max(depth, 100_000))
    w = sg.segment_window()
    steps = {}
    for dd in range(1, depth + 1):
        steps[f"_v{dd}"] = (lambda dd: lambda: F.lag("v", dd).over(w))(dd)()
        steps[f"_m{dd}"] = (lambda dd: lambda: F.lag("mult", dd).over(w))(dd)()
    lay = lay.withColumns(steps)
    zero = F.transform(F.col("v"), lambda x: F.lit(0.0))
    one = F.transform(F.col("v"), lambda x: F.lit(1.0))
    acc, prod = zero, one
    for dd in range(1, depth + 1):
        vd = F.coalesce(F.col(f"_v{dd}"), zero)
        md = F.coalesce(F.col(f"_m{dd}"), zero)
        acc = F.zip_with(acc, F.zip_with(prod, vd, lambda p, v: p * v), lambda a, b: a + b)
        prod = F.zip_with(prod, md, lambda p, m: p * m)
    out = lay.withColumn("y_in", acc).withColumn("y_out", F.zip_with(F.zip_with(F.col("mult"), F.col("y_in"), lambda m, y: m * y),
                                                                      F.col("v"), lambda a, b: a + b))
    return sg.drop_halo(out).select("series_id", F.col("_gseg").alias("_seg"), "y_in", "y_out")


GARCH_B_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("_seg", T.LongType()),
                               T.StructField("ll", ARR), T.StructField("al", ARR), T.StructField("be", ARR)])


def _garch_pass_b(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(sg.POS)
    al, be = _garch_own_grid(pdf)
    s2 = float(pdf["_s2"].iloc[0])
    om = s2 * (1 - al - be)
    y = np.asarray(pdf["y_in"].iloc[0], dtype=float)
    ll = np.zeros_like(al)
    for first, ep, e in zip(pdf["_first"].to_numpy(), pdf["_ep2"].to_numpy(dtype=float, na_value=np.nan),
                            pdf["_eps"].to_numpy(dtype=float)):
        y = np.full_like(al, s2) if first else be * y + om + al * ep
        ll += -0.5 * (np.log(2 * np.pi) + np.log(y) + e * e / y)
    return pd.DataFrame([[pdf["series_id"].iloc[0], int(pdf["_seg"].iloc[0]), ll, al, be]], columns=["series_id", "_seg", "ll", "al", "be"])


def _garch_search(rows: DataFrame, size: int) -> DataFrame:
    """Best candidate of each series' grid: alpha, beta, loglik and the last variance."""
    seg = rows.groupBy("series_id", "_seg").applyInPandas(_garch_pass_a, GARCH_A_SCHEMA)
    chain = materialize(_garch_chain(materialize(seg), garch_chain_depth(size)))
    ll = materialize(rows.join(chain.select("series_id", "_seg", "y_in"), ["series_id", "_seg"])
                     .groupBy("series_id", "_seg").applyInPandas(_garch_pass_b, GARCH_B_SCHEMA))
    tot = ll.select("series_id", F.posexplode("ll").alias("c", "ll")).groupBy("series_id", "c").agg(F.sum("ll").alias("loglik"))
    best = tot.groupBy("series_id").agg(F.max(F.struct("loglik", (-F.col("c")).alias("m"))).alias("b")) \
        .select("series_id", F.col("b.loglik").alias("loglik"), (-F.col("b.m")).alias("c"))
    grid = ll.groupBy("series_id").agg(F.first("al").alias("al"), F.first("be").alias("be"))
    last = chain.groupBy("series_id").agg(F.max_by("y_out", "_seg").alias("_yo"))
    return best.join(grid, "series_id").join(last, "series_id").select(
        "series_id", F.col("al")[F.col("c")].alias("alpha"), F.col("be")[F.col("c")].alias("beta"), "loglik", F.col("_yo")[F.col("c")].alias("last_var"))


def garch_fit(df: DataFrame, value: str = "close", key: str = "series_id", ts: str = "ts",
              size: int = sg.DEFAULT_SEGMENT_ROWS, unit: str = "auto") -> DataFrame:
    """F3 fit: GARCH(1,1) with constant mean on percent returns, variance targeting
    omega = s2 (1 - alpha - beta), sigma2 of the first return = s2, (alpha, beta) by maximum
    Gaussian likelihood on a 0.05 grid over all stationary values, refined to 0.005 around its
    best point. Returns the fitted parameters and last variance."""
    if key != "series_id":
        df = df.withColumnRenamed(key, "series_id")
    df = reuse_input(df.select("series_id", ts, value))
    r = windowed(df.select("series_id", ts, value),
                 [{"_r": lambda w: (F.try_divide(F.col(value), F.lag(value, 1).over(w)) - 1.0) * 100.0}],
                 before=1, ts=ts, size=size, unit=unit).filter(F.col("_r").isNotNull())
    mom = r.groupBy("series_id").agg(F.avg("_r").alias("_mu"))
    e = r.join(sg._maybe_broadcast(mom), "series_id").withColumn("_eps", F.col("_r") - F.col("_mu"))
    s2 = e.groupBy("series_id").agg(F.avg(F.col("_eps") * F.col("_eps")).alias("_s2"), F.first("_mu").alias("mu"),
                                    F.count(F.lit(1)).alias("n"))
    s2 = sg._maybe_broadcast(s2)
    ok = s2.filter((F.col("n") >= GARCH_MIN_RETURNS) & (F.col("_s2") > 0)).select("series_id", "_s2")
    e = e.join(ok, "series_id")
    rows = windowed(e, [{"_ep2": lambda w: F.pow(F.lag("_eps", 1).over(w), 2)}], before=1, ts=ts, size=size, unit=unit,
                    keep_pos=True)
    rows = rows.withColumn("_first", F.col(sg.POS) == 1).withColumn("_seg", F.floor((F.col(sg.POS) - 1) / size).cast("bigint"))
    rows = materialize(rows.select("series_id", "_seg", sg.POS, "_first", "_ep2", "_eps", "_s2"))
    none = F.lit(None).cast("double")
    coarse = _garch_search(rows.withColumn("_ca", none).withColumn("_cb", none), size)
    centre = materialize(coarse.select("series_id", F.col("alpha").alias("_ca"), F.col("beta").alias("_cb")))
    found = _garch_search(rows.join(centre, "series_id"), size)
    last_eps = rows.groupBy("series_id").agg(F.max_by("_eps", sg.POS).alias("last_eps"))
    fitted = found.join(last_eps, "series_id")
    every = df.select("series_id").distinct()
    reason = (F.when(F.col("n").isNull() | (F.col("n") < GARCH_MIN_RETURNS), F.lit(f"needs {GARCH_MIN_RETURNS} returns"))
               .when(F.col("_s2") <= 0, F.lit("constant returns")))
    out = (every.join(s2, "series_id", "left").join(fitted, "series_id", "left")
                .select("series_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "mu", F.col("_s2").alias("uncond_var"),
                        "alpha", "beta", "loglik", "last_var", "last_eps", reason.alias("reason")))
    return out.withColumn("omega", F.col("uncond_var") * (1 - F.col("alpha") - F.col("beta")))


def garch_forecast(fit: DataFrame, horizon: int = 30) -> DataFrame:
    """F3 forecast: sigma2_{n+1} = omega + alpha eps_n^2 + beta sigma2_n, then
    sigma2_{n+h} = s2 + (alpha + beta)^(h-1) (sigma2_{n+1} - s2). Variance and volatility."""
    one = F.col("omega") + F.col("alpha") * F.col("last_eps") * F.col("last_eps") + F.col("beta") * F.col("last_var")
    h = F.col("horizon")
    var = F.col("uncond_var") + F.pow(F.col("alpha") + F.col("beta"), h - 1) * (F.col("_v1") - F.col("uncond_var"))
    return (fit.withColumn("_v1", one)
               .select("series_id", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"), "_v1", "uncond_var",
                       "alpha", "beta")
               .select("series_id", F.col("horizon").cast("int"), var.alias("variance"))
               .withColumn("volatility", F.sqrt("variance")))
