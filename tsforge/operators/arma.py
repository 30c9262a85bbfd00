"""Linear time-series models fitted from Gram sums (F1 ARIMA(p,0,q), F4 VAR).

* ARIMA(p, 0, 1) with constant, two estimators:
  - ``arima_css`` (default): conditional least squares profiled over theta (see there);
  - ``arima_hr``: Hannan-Rissanen (1982): a long autoregression gives innovation estimates,
    then x_t is regressed on its p lags and the lagged innovation. Both stages are least
    squares on lag columns of the segmented layout, so nothing is sequential over the series.
  Only the 30-step forecast recursion runs per series, on its last rows.
* VAR on several columns: lag order 0..pmax by AIC on the common sample (one Gram matrix
  serves every order), then a refit with the chosen order on its longer sample.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions import solvers
from tsforge.operators import segments as sg
from tsforge.operators.features import windowed
from tsforge.operators.regression import gram
from tsforge.session import materialize, reuse_input

ARR = T.ArrayType(T.DoubleType())


def _lagcols(src: str, prefix: str, k: int, start: int = 1):
    return {f"{prefix}{i}": (lambda i: lambda w: F.lag(src, i).over(w))(i) for i in range(start, k + 1)}


def _unpack(pdf: pd.DataFrame, d: int) -> np.ndarray:
    g = np.zeros(d * d)
    gr = pdf[pdf["_kind"] == 0]
    g[gr["idx"].to_numpy(dtype=int)] = gr["val"].to_numpy(dtype=float)
    return g.reshape(d, d)


# ---- ARIMA(p, 0, 1) by Hannan-Rissanen ----------------------------------------------------------

COEF_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("coef", ARR),
                            T.StructField("nobs", T.LongType()), T.StructField("sse", T.DoubleType())])


def _ols_solve(d: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        g = _unpack(pdf, d)
        k = d - 1
        beta, ssr, _ = solvers.ols_from_gram(g[:k, :k], g[:k, k], g[k, k])
        return pd.DataFrame([[pdf["series_id"].iloc[0], beta.tolist(), int(round(g[0, 0])), ssr]],
                            columns=["series_id", "coef", "nobs", "sse"])
    return run


def ols_by_series(rows: DataFrame, xcols: list[str], ycol: str) -> DataFrame:
    """Per-series OLS of ``ycol`` on ``xcols`` (first column should be the constant 1) from
    the summed Gram matrix; rows with a null regressor or response are dropped."""
    names = xcols + [ycol]
    ok = rows.dropna(subset=names)
    g = gram(ok, names).withColumn("_kind", F.lit(0))
    return g.groupBy("series_id").applyInPandas(_ols_solve(len(names)), COEF_SCHEMA)


def _dot_lags(coef: str, lags: str, offset: int = 1):
    """coef[offset:] . lags (JVM-side fold)."""
    return F.aggregate(F.zip_with(F.slice(F.col(coef), F.lit(offset + 1), F.greatest(F.size(coef) - offset, F.lit(0))), F.col(lags), lambda a, b: a * b),
                       F.lit(0.0), lambda acc, x: acc + x)


ARIMA_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("horizon", T.IntegerType()),
                             T.StructField("forecast", T.DoubleType()), T.StructField("const", T.DoubleType()),
                             T.StructField("ar", ARR), T.StructField("ma", T.DoubleType())])


def _arima_forecast(p: int, horizon: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        c = np.asarray(r["coef2"], dtype=float)
        const, phi, theta = c[0], c[1:p + 1], c[p + 1]
        hist = list(np.asarray(r["last_x"], dtype=float))  # oldest .. newest, p values
        e_last = float(r["last_e2"])
        out = []
        for h in range(1, horizon + 1):
            f = const + sum(phi[i] * hist[-1 - i] for i in range(p)) + (theta * e_last if h == 1 else 0.0)
            out.append((r["series_id"], h, float(f), float(const), [float(v) for v in phi], float(theta)))
            hist.append(f)
        return pd.DataFrame(out, columns=[f.name for f in ARIMA_SCHEMA.fields])
    return run


def arima_hr(df: DataFrame, value: str = "close", p: int = 4, horizon: int = 30,
             key: str = "series_id", ts: str = "ts", **kw) -> DataFrame:
    """ARIMA(p,0,1) with constant by Hannan-Rissanen, and its ``horizon``-step forecast.

    Stage 1: AR(m) per series with m = min(max(floor(ln(n)^2), 2p), (n-2)/3)
    -> innovations e_t. Stage 2: x_t on 1, x_{t-1..t-p}, e_{t-1} -> const, phi, theta.
    Forecast: x_{n+1} = c + phi . x + theta e_n, later steps without the MA term. Lag columns
    are built once for the largest m; a series' lags beyond its own m are zero. Series too
    short for the two regressions get null forecasts and a ``reason``."""
    if key != "series_id":
        df = df.withColumnRenamed(key, "series_id")
    base = reuse_input(df.select("series_id", ts, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull()))
    n = F.col("_n").cast("double")
    ms = F.least(F.greatest(F.floor(F.pow(F.log(n), 2)), F.lit(2 * p)), F.floor((n - 2) / 3)).cast("int")
    st = sg._maybe_broadcast(base.groupBy("series_id").agg(F.count(F.lit(1)).alias("_n"), F.avg("_x").alias("_mu"))
                             .withColumn("_m", ms))
    m = max(int(st.agg(F.max("_m")).first()[0] or 0), p + 1)
    ok = st.filter(F.col("_m") >= p + 1).select("series_id", "_m", "_mu")
    # centred per series: the regressions keep their fit and the Gram matrix its conditioning
    fit_base = base.join(ok, "series_id").withColumn("_x", F.col("_x") - F.col("_mu")).drop("_mu")
    rows = windowed(fit_base, [{**_lagcols("_x", "_xl", m), "_one": lambda w: F.lit(1.0)}],
                    before=m, ts=ts, keep_pos=True, **kw)
    rows = rows.withColumns({f"_xl{i}": F.when(F.lit(i) <= F.col("_m"), F.col(f"_xl{i}")).otherwise(0.0)
                             for i in range(p + 1, m + 1)}).cache()
    stage1 = rows.filter(F.col(sg.POS) > F.col("_m"))
    c1 = ols_by_series(stage1, ["_one"] + [f"_xl{i}" for i in range(1, m + 1)], "_x")
    lagarr = F.array(*[F.col(f"_xl{i}") for i in range(1, m + 1)])
    r1 = rows.join(sg._maybe_broadcast(c1.select("series_id", F.col("coef").alias("_c1"))), "series_id").withColumn("_lags_m", lagarr)
    r1 = r1.withColumn("_e", F.when(F.col(sg.POS) > F.col("_m"), F.col("_x") - F.col("_c1")[0] - _dot_lags("_c1", "_lags_m")))
    r1 = r1.select("series_id", ts, sg.POS, "_x", "_one", *[f"_xl{i}" for i in range(1, p + 1)], "_e")
    r2 = windowed(r1, [{"_el1": lambda w: F.lag("_e", 1).over(w)}], before=1, ts=ts, keep_pos=True, **kw).cache()
    xs = ["_one"] + [f"_xl{i}" for i in range(1, p + 1)] + ["_el1"]
    c2 = ols_by_series(r2, xs, "_x")
    # last p values and the last stage-2 innovation of each series
    fitted = r2.join(sg._maybe_broadcast(c2.select("series_id", F.col("coef").alias("_c2"))), "series_id").withColumn(
        "_e2", F.col("_x") - F.aggregate(F.zip_with(F.col("_c2"), F.array(*[F.col(c) for c in xs]), lambda a, b: a * b),
                                          F.lit(0.0), lambda acc, x: acc + x))
    last = fitted.groupBy("series_id").agg(
        F.max_by(F.array(*[F.col(f"_xl{i}") for i in range(p - 1, 0, -1)], F.col("_x")), sg.POS).alias("last_x"),
        F.max_by("_e2", sg.POS).alias("last_e2"))
    pars = c2.select("series_id", F.col("coef").alias("coef2")).join(last, "series_id")
    fc = pars.groupBy("series_id").applyInPandas(_arima_forecast(p, horizon), ARIMA_SCHEMA)
    mu = ok.select("series_id", "_mu")
    phi_sum = F.aggregate(F.col("ar"), F.lit(0.0), lambda acc, x: acc + x)
    fc = (fc.join(mu, "series_id")
            .withColumn("forecast", F.col("forecast") + F.col("_mu"))
            .withColumn("const", F.col("const") + F.col("_mu") * (1.0 - phi_sum)).drop("_mu"))
    short = (st.filter(F.col("_m") < p + 1)
               .select("series_id", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
               .select("series_id", F.col("horizon").cast("int"), F.lit(None).cast("double").alias("forecast"),
                       F.lit(None).cast("double").alias("const"), F.lit(None).cast(ARR).alias("ar"),
                       F.lit(None).cast("double").alias("ma")))
    reason = F.when(F.col("const").isNull(), F.lit(f"too short for ARIMA({p},0,1)"))
    return fc.unionByName(short).withColumn("reason", reason)


# ---- VAR --------------------------------------------------------------------------------------------

VAR_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("lag_order", T.IntegerType()),
                           T.StructField("horizon", T.IntegerType()), T.StructField("variable", T.StringType()),
                           T.StructField("forecast", T.DoubleType()), T.StructField("reason", T.StringType())])


def _var_solve(names: list[str], pmax: int, horizon: int):
    m = len(names)
    d = 1 + m * pmax + m

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sid = pdf["series_id"].iloc[0]
        g = _unpack(pdf, d)
        heads = pdf[pdf["_kind"] == 1]
        tails = pdf[pdf["_kind"] == 2].sort_values("idx")
        mu = np.asarray(pdf["_mu"].iloc[0], dtype=float)
        sd = np.asarray(pdf["_sd"].iloc[0], dtype=float)
        ycols = list(range(d - m, d))
        T_ = g[0, 0]
        best, bp = None, None
        for p in range(pmax + 1):
            xc = list(range(1 + m * p))
            if T_ <= len(xc) + m:  # fewer rows than a residual covariance needs
                break
            xtx = g[np.ix_(xc, xc)]
            xty = g[np.ix_(xc, ycols)]
            b = np.linalg.lstsq(xtx, xty, rcond=None)[0]
            sse = g[np.ix_(ycols, ycols)] - xty.T @ b - b.T @ xty + b.T @ xtx @ b
            sign, ld = np.linalg.slogdet(sse / T_)
            aic = ld + 2.0 * (p * m * m + m) / T_
            if sign > 0 and np.isfinite(aic) and (best is None or aic < best):
                best, bp = aic, p
        if bp is None:
            why = f"too short or singular for a VAR of {m} series"
            return pd.DataFrame([(sid, None, h, nm, None, why) for h in range(1, horizon + 1) for nm in names],
                                columns=[f.name for f in VAR_SCHEMA.fields])
        xc = list(range(1 + m * bp))
        sel = xc + ycols
        gp = g[np.ix_(sel, sel)].copy()
        for _, h in heads.iterrows():
            if int(h["idx"]) >= bp + 1:
                v = np.asarray(h["vec"], dtype=float)[sel]
                gp += np.outer(v, v)
        k = len(xc)
        b = np.linalg.lstsq(gp[:k, :k], gp[:k, k:], rcond=None)[0]  # (1 + m p) x m
        hist = [np.asarray(v, dtype=float) for v in tails["vec"]]  # standardised rows, oldest first
        out = []
        for hh in range(1, horizon + 1):
            z = [1.0] + [x for i in range(1, bp + 1) for x in hist[-i]]
            f = np.asarray(z) @ b
            hist.append(f)
            for j, nm in enumerate(names):
                out.append((sid, bp, hh, nm, float(f[j] * sd[j] + mu[j]), None))
        return pd.DataFrame(out, columns=[f.name for f in VAR_SCHEMA.fields])
    return run


def var_forecast(df: DataFrame, cols: list[str], pmax: int = 5, horizon: int = 30, key: str = "series_id", ts: str = "ts",
                 **kw) -> DataFrame:
    """VAR with constant on ``cols`` (standardised per series), lag order 0..pmax by AIC
    (log det Sigma + 2 k / T on the common sample), refit on the longer sample of the chosen
    order, ``horizon``-step forecast in the original units (long form: variable, forecast). Orders
    that leave no degrees of freedom for the residual covariance are not considered; with none
    left, forecasts are null with a ``reason``."""
    if key != "series_id":
        df = df.withColumnRenamed(key, "series_id")
    base = reuse_input(df.select("series_id", ts, *[F.col(c).cast("double").alias(c) for c in cols]).dropna())
    st = base.groupBy("series_id").agg(F.array(*[F.avg(c) for c in cols]).alias("_mu"),
                                       F.array(*[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)) for c in cols]).alias("_sd"),
                                       F.count(F.lit(1)).alias("_n"))
    stb = sg._maybe_broadcast(st)
    z = base.join(stb, "series_id").select("series_id", ts, *[((F.col(c) - F.col("_mu")[j]) / F.col("_sd")[j]).alias(f"_z{j}")
                                                              for j, c in enumerate(cols)])
    lags = {}
    for i in range(1, pmax + 1):
        for j in range(len(cols)):
            lags[f"_l{i}_{j}"] = (lambda i, j: lambda w: F.lag(f"_z{j}", i).over(w))(i, j)
    rows = windowed(z, [lags], before=pmax, ts=ts, keep_pos=True, **kw).withColumn("_one", F.lit(1.0)).cache()
    names = ["_one"] + [f"_l{i}_{j}" for i in range(1, pmax + 1) for j in range(len(cols))] + [f"_z{j}" for j in range(len(cols))]
    common = rows.filter(F.col(sg.POS) >= pmax + 1)
    g = gram(common, names).select("series_id", F.lit(0).alias("_kind"), "idx", "val", F.lit(None).cast(ARR).alias("vec"))
    heads = rows.filter(F.col(sg.POS) < pmax + 1).select(
        "series_id", F.lit(1).alias("_kind"), F.col(sg.POS).cast("int").alias("idx"), F.lit(None).cast("double").alias("val"),
        F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in names]).alias("vec"))
    tails = rows.join(stb.select("series_id", "_n"), "series_id").filter(F.col(sg.POS) > F.col("_n") - pmax).select(
        "series_id", F.lit(2).alias("_kind"), F.col(sg.POS).cast("int").alias("idx"), F.lit(None).cast("double").alias("val"),
        F.array(*[F.col(f"_z{j}") for j in range(len(cols))]).alias("vec"))
    parts = g.unionByName(heads).unionByName(tails).join(stb.select("series_id", "_mu", "_sd"), "series_id")
    return parts.groupBy("series_id").applyInPandas(_var_solve(cols, pmax, horizon), VAR_SCHEMA)


# ---- ARIMA(p, 0, 1) by conditional least squares profiled over theta -------------------------

CSS_THETAS = np.round(np.arange(-0.99, 0.99001, 0.01), 10)
# w = (1 + theta L)^-1 x forgets its start as |theta|^k: after CSS_HALO rows the start weighs
# 0.99^CSS_HALO <= 1e-20, so a segment that replays CSS_HALO earlier rows has w to double precision.
CSS_HALO = int(np.ceil(20.0 / -np.log10(0.99)))
_CSS_CHUNK = 8192


def _css_segment(p: int):
    G = len(CSS_THETAS)
    k = p + 2

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(sg.POS)
        x = pdf["_x"].to_numpy(dtype=float)
        pos = pdf[sg.POS].to_numpy()
        home = pdf[sg.HOME].to_numpy(dtype=bool)
        hi = np.flatnonzero(home)
        last = hi[-1]
        gram, tail = np.zeros((G, k, k)), []
        w, before = np.zeros(G), np.zeros((p, G))  # the filter and its last p rows, chunk after chunk
        for s in range(0, len(x), _CSS_CHUNK):
            e = min(s + _CSS_CHUNK, len(x))
            W = np.empty((e - s + p, G))
            W[:p] = before
            for i in range(s, e):
                w = x[i] - CSS_THETAS * w
                W[i - s + p] = w
            r = np.flatnonzero(home[s:e] & (pos[s:e] > p)) + p
            if len(r):
                Z = np.stack([np.ones((len(r), G))] + [W[r - j] for j in range(1, p + 1)] + [W[r]], axis=-1)
                gram += np.einsum("rgk,rgl->gkl", Z, Z)
            if s <= last < e:
                tail = W[last - s if last >= p else p:last - s + p + 1]
            before = W[-p:]
        first = max(0, last - p)
        return pd.DataFrame([[pdf["series_id"].iloc[0], int(pos[last]), gram.ravel().tolist(),
                              tail.ravel().tolist(), x[first:last + 1].tolist()]],
                            columns=["series_id", "last_pos", "gram", "last_w", "last_x"])
    return run


CSS_SEG_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("last_pos", T.LongType()),
                               T.StructField("gram", ARR), T.StructField("last_w", ARR), T.StructField("last_x", ARR)])


def _css_solve(p: int, horizon: int):
    G = len(CSS_THETAS)
    k = p + 2

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sid = pdf["series_id"].iloc[0]
        g = np.zeros(G * k * k)
        gr = pdf[pdf["_kind"] == 0]
        g[gr["idx"].to_numpy(dtype=int)] = gr["val"].to_numpy(dtype=float)
        g = g.reshape(G, k, k)
        sse = np.full(G, np.inf)
        coefs = np.zeros((G, k - 1))
        for j in range(G):
            if g[j, 0, 0] <= k:
                continue
            beta, ssr, _ = solvers.ols_from_gram(g[j, :-1, :-1], g[j, :-1, -1], g[j, -1, -1])
            sse[j], coefs[j] = ssr, beta
        if not np.isfinite(sse).any():
            return pd.DataFrame(columns=[f.name for f in ARIMA_CSS_SCHEMA.fields])
        b = int(np.argmin(sse))
        theta = float(CSS_THETAS[b])
        cp, phi = coefs[b, 0], coefs[b, 1:]
        st = pdf[pdf["_kind"] == 1].iloc[0]
        lw = np.asarray(st["last_w"], dtype=float).reshape(-1, G)[:, b]   # w_{n-p..n}
        lx = list(np.asarray(st["last_x"], dtype=float))                  # x_{n-p..n}
        e_n = lw[-1] - cp - sum(phi[i] * lw[-2 - i] for i in range(p))
        const = cp * (1.0 + theta)
        out = []
        for h in range(1, horizon + 1):
            f = const + sum(phi[i] * lx[-1 - i] for i in range(p)) + (theta * e_n if h == 1 else 0.0)
            out.append((sid, h, float(f), float(const), [float(v) for v in phi], theta, float(sse[b])))
            lx.append(f)
        return pd.DataFrame(out, columns=[f.name for f in ARIMA_CSS_SCHEMA.fields])
    return run


ARIMA_CSS_SCHEMA = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("horizon", T.IntegerType()),
                                 T.StructField("forecast", T.DoubleType()), T.StructField("const", T.DoubleType()),
                                 T.StructField("ar", ARR), T.StructField("ma", T.DoubleType()), T.StructField("sse", T.DoubleType())])


def arima_css(df: DataFrame, value: str = "close", p: int = 4, horizon: int = 30, key: str = "series_id", ts: str = "ts",
              size: int = sg.DEFAULT_SEGMENT_ROWS, unit: str = "auto") -> DataFrame:
    """ARIMA(p,0,1) with constant by conditional least squares, profiled over the MA
    coefficient theta on a 0.01 grid in [-0.99, 0.99], and its ``horizon``-step forecast.

    For each theta, w = (1 + theta L)^-1 x (w_t = x_t - theta w_{t-1}) turns the model into
    AR(p) + constant on w; its SSE comes from per-segment Gram sums (segments replay
    ``CSS_HALO`` earlier rows, after which the filter's start no longer matters) summed over
    segments; the theta with the smallest SSE wins. Values are centred per series first.
    Series too short for the regression get null forecasts and a ``reason``."""
    if key != "series_id":
        df = df.withColumnRenamed(key, "series_id")
    base = reuse_input(df.select("series_id", ts, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull()))
    st = sg._maybe_broadcast(base.groupBy("series_id").agg(F.count(F.lit(1)).alias("_n"), F.avg("_x").alias("_mu")))
    ok = st.filter(F.col("_n") >= p + 10).select("series_id", "_mu")
    seg_size = max(size, 2 * CSS_HALO)
    lay = sg.series_layout(base.join(ok, "series_id").withColumn("_x", F.col("_x") - F.col("_mu")).drop("_mu"),
                           before=CSS_HALO, size=seg_size, ts=ts, unit=unit)
    segs = lay.select("series_id", sg.SEG, sg.POS, sg.HOME, "_x").groupBy("series_id", sg.SEG).applyInPandas(
        _css_segment(p), CSS_SEG_SCHEMA)
    segs = materialize(segs)
    g = (segs.select("series_id", F.posexplode("gram").alias("idx", "val")).groupBy("series_id", "idx").agg(F.sum("val").alias("val"))
             .select("series_id", F.lit(0).alias("_kind"), "idx", "val", F.lit(None).cast(ARR).alias("last_w"),
                     F.lit(None).cast(ARR).alias("last_x")))
    last = (segs.groupBy("series_id").agg(F.max_by(F.struct("last_w", "last_x"), "last_pos").alias("_l"))
                .select("series_id", F.lit(1).alias("_kind"), F.lit(-1).cast("int").alias("idx"), F.lit(None).cast("double").alias("val"),
                        "_l.last_w", "_l.last_x"))
    fc = g.unionByName(last).groupBy("series_id").applyInPandas(_css_solve(p, horizon), ARIMA_CSS_SCHEMA)
    fc = (fc.join(ok, "series_id")
            .withColumn("forecast", F.col("forecast") + F.col("_mu"))
            .withColumn("const", F.col("const") + F.col("_mu") * (1.0 - F.aggregate("ar", F.lit(0.0), lambda a, x: a + x)))
            .drop("_mu"))
    short = (st.join(ok.select("series_id"), "series_id", "left_anti")
               .select("series_id", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
               .select("series_id", F.col("horizon").cast("int"), *[F.lit(None).cast(t).alias(n) for n, t in
                       (("forecast", "double"), ("const", "double"), ("ar", "array<double>"), ("ma", "double"), ("sse", "double"))]))
    reason = F.when(F.col("const").isNull(), F.lit(f"too short for ARIMA({p},0,1)"))
    return fc.unionByName(short).withColumn("reason", reason)
