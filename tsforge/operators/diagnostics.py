"""Per-series statistics (T2-T12): autocorrelation, Ljung-Box, KPSS, PACF, Yule-Walker,
seasonal decomposition, anomalies and stationarity verdicts.

Everything that touches rows is a Spark aggregation over the segmented window layout:
one pass produces, per series, n, the mean and the lagged cross-product sums
S_k = sum_t e_t e_{t-k} of the demeaned values (k = 0..K). The tests are closed forms of
those sums; the two recursive ones (PACF, Yule-Walker) run on the K+1 sums of one series in
``applyInPandas`` (bounded input per group).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions import solvers
from tsforge.functions.columns import chi2_sf_even, safe_div
from tsforge.operators import segments as sg
from tsforge.operators.features import windowed
from tsforge.session import materialize, reuse_input

Z95 = 1.959963984540054


def demeaned(df: DataFrame, value: str = "close", key: str = "series_id") -> DataFrame:
    """Adds ``_e = value - mean(value)`` per series, exactly 0 for a constant series (the planner
    broadcasts the per-series table if its files are small, and shuffles it otherwise)."""
    df = reuse_input(df)
    mean = F.when(F.min(value) == F.max(value), F.min(value).cast("double")).otherwise(F.avg(value))
    m = sg.home_rows(df).groupBy(key).agg(mean.alias("_mu"), F.count(value).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    m = sg._maybe_broadcast(m)
    if sg.stored(df) and m.where("_n < _rows").limit(1).count():  # stored positions count the nulls, too
        df = sg.home_rows(df).drop(sg.POS, sg.LEN)
    return df.filter(F.col(value).isNotNull()).join(m.drop("_rows"), key).withColumn("_e", F.col(value) - F.col("_mu"))


def autocov_sums(df: DataFrame, value: str = "close", max_lag: int = 40, key: str = "series_id", ts: str = "ts",
                 **kw) -> DataFrame:
    """``key, n, mean, s`` with ``s[k] = sum_t e_t * e_{t-k}`` for k = 0..max_lag."""
    d = demeaned(df, value, key)
    return _autocov_from(d.select(key, ts, "_e", "_mu", "_n", *sg.layout_columns(d)), max_lag, key, ts, **kw)


def _autocov_from(d: DataFrame, max_lag: int, key: str, ts: str, **kw) -> DataFrame:
    """Lagged cross-product sums of ``_e`` (rows may already carry ``_pos``)."""
    lags = {f"_l{k}": (lambda k: lambda w: F.lag("_e", k).over(w))(k) for k in range(1, max_lag + 1)}
    d = windowed(d, [lags], before=max_lag, key=key, ts=ts, **kw)
    sums = [F.sum(F.col("_e") * F.col("_e")).alias("_s0")] + [F.sum(F.col("_e") * F.col(f"_l{k}")).alias(f"_s{k}")
                                                             for k in range(1, max_lag + 1)]
    a = d.groupBy(key).agg(F.first("_n").alias("n"), F.first("_mu").alias("mean"), *sums)
    return a.select(key, F.col("n").cast("bigint"), "mean",
                    F.array(*[F.coalesce(F.col(f"_s{k}"), F.lit(0.0)) for k in range(max_lag + 1)]).alias("s"))


def acf(sums: DataFrame, nlags: int = 30, key: str = "series_id") -> DataFrame:
    """T4: r_k = S_k / S_0 for k = 0..nlags (long form)."""
    return (sums.select(key, "n", F.posexplode(F.slice("s", 1, nlags + 1)).alias("lag", "_sk"), F.col("s")[0].alias("_s0"))
                .select(key, "n", F.col("lag").cast("int"), safe_div(F.col("_sk"), F.col("_s0")).alias("acf")))


def acf_bands(acf_long: DataFrame, key: str = "series_id") -> DataFrame:
    """Bartlett band half-width 1.96*sqrt((1 + 2*sum_{j<k} r_j^2)/n) for k >= 2, 1.96/sqrt(n)
    at k = 1, 0 at k = 0; PACF band 1.96/sqrt(n). Running sum over the small lag table."""
    w = Window.partitionBy(key).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    r2 = F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf")).otherwise(0.0)
    a = acf_long.withColumn("_r2", r2)
    cum = F.coalesce(F.sum("_r2").over(w), F.lit(0.0))
    var = F.when(F.col("lag") == 0, 0.0).when(F.col("lag") == 1, 1.0 / F.col("n")).otherwise((1.0 + 2.0 * cum) / F.col("n"))
    return a.select(key, "lag", "acf", (Z95 * F.sqrt(var)).alias("acf_band"), (Z95 / F.sqrt(F.col("n"))).alias("pacf_band"))


def ljung_box(sums: DataFrame, lags: int = 10, key: str = "series_id") -> DataFrame:
    """Q = n(n+2) sum_{k<=lags} r_k^2/(n-k); p from the chi-square(lags) tail (closed form)."""
    n = F.col("n").cast("double")
    terms = [safe_div(F.pow(safe_div(_s(k), _s(0)), 2), n - k) for k in range(1, lags + 1)]
    q = n * (n + 2.0) * sum(terms[1:], terms[0])
    reason = (F.when(F.col("n") <= lags, F.lit(f"needs more than {lags} observations"))
               .when(_s(0) == 0, F.lit("constant series")))
    return (sums.select(key, "n", F.when(reason.isNull(), q).alias("lb_stat"), reason.alias("lb_reason"))
                .withColumn("lb_pvalue", chi2_sf_even(F.col("lb_stat"), lags)))


def _s(i):
    """S_i from the sums array (null past its end instead of an ANSI error)."""
    return F.try_element_at(F.col("s"), (i + 1) if not isinstance(i, int) else F.lit(i + 1))


def kpss_cov_lags() -> F.Column:
    return F.floor(F.pow(F.col("n").cast("double"), 2.0 / 9.0)).cast("int")


def kpss_lag() -> F.Column:
    """Automatic bandwidth of Hobijn et al. (1998) from the autocovariance sums; null for a
    constant series and while fewer than ``kpss_cov_lags`` sums are known."""
    n = F.col("n").cast("double")
    m = kpss_cov_lags()
    c = F.transform(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), lambda i: F.when(i <= m, _s(i) / (n / 2.0)).otherwise(0.0))
    s0 = F.col("s")[0] / n + F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    s1 = F.aggregate(F.zip_with(c, F.sequence(F.lit(1), F.size(c)), lambda x, i: x * i), F.lit(0.0), lambda acc, x: acc + x)
    g = 1.1447 * F.pow(F.pow(F.try_divide(s1, s0), 2), 1.0 / 3.0)
    lags = F.floor(g * F.pow(n, 1.0 / 3.0))
    defined = (F.col("s")[0] > 0) & lags.isNotNull() & ~F.isnan(lags)
    return F.when(defined, F.least(lags, n - 1)).cast("int")


def _segment_lag_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """S_k of one segment for k = 0.. the series' own reach; halo rows only serve as partners."""
    pdf = pdf.sort_values(sg.POS)
    e, home = pdf["_e"].to_numpy(float), int((~pdf[sg.HOME]).sum())
    need = int(pdf["_need"].iloc[0])
    s = [float(e[max(home, k):] @ e[max(home, k) - k:len(e) - k]) if len(e) > max(home, k) else 0.0 for k in range(need + 1)]
    return pd.DataFrame({"series_id": [pdf["series_id"].iloc[0]], "s": [s]})


def lag_sums(d: DataFrame, need: DataFrame, key: str = "series_id", size: int = sg.DEFAULT_SEGMENT_ROWS) -> DataFrame:
    """``key, s`` with ``s[k] = sum_t e_t e_{t-k}`` for k = 0..``_need`` of that series (table ``need``:
    key, ``_need``). ``d`` holds ``_pos`` and ``_e``. The plan's width does not depend on the
    reach: segments carry their own series' halo and are summed in bounded Python groups."""
    j = d.select(F.col(key).alias("series_id"), sg.POS, "_e").join(need.select(F.col(key).alias("series_id"), "_need"), "series_id")
    seg = sg.segmented(j, before="_need", size=size, key="series_id")
    part = seg.groupBy("series_id", sg.SEG).applyInPandas(_segment_lag_sums, "series_id string, s array<double>")
    each = part.select("series_id", F.posexplode("s").alias("k", "v")).groupBy("series_id", "k").agg(F.sum("v").alias("v"))
    return each.groupBy("series_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("s")) \
        .withColumnRenamed("series_id", key)


def kpss(df: DataFrame, value: str = "close", key: str = "series_id", ts: str = "ts", sums: DataFrame | None = None,
         max_lag: int = 40, **kw) -> DataFrame:
    """KPSS level-stationarity test with automatic bandwidth.

    eta = sum_t S_t^2 / n^2 with S the running sum of the demeaned values (two-level scan);
    long-run variance (S_0 + 2 sum_{i<=l} (1 - i/(l+1)) S_i) / n from the autocovariance sums.
    ``max_lag`` sums are made for every series in one window pass; the few series whose own
    bandwidth needs more get theirs from ``lag_sums``. A constant series has no statistic and no
    p-value, with a ``reason``."""
    df = reuse_input(df.select(key, ts, value, *sg.layout_columns(df)))
    # positions of the demeaned series once, shared by the lag sums and the running sum
    d = demeaned(df, value, key)
    if sg.stored(d):
        d = d.select(key, ts, "_e", "_mu", "_n", *sg.layout_columns(d))
    else:
        d = reuse_input(sg.with_positions(d.select(key, ts, "_e", "_mu", "_n"), key, ts, kw.get("unit", "auto")))
    sums = materialize(sums if sums is not None else _autocov_from(d, max_lag, key, ts, **kw))
    for _ in range(2):  # first the sums the bandwidth is made of, then those the variance needs
        wanted = sums.withColumn("_need", F.when(F.col("s")[0] > 0, F.greatest(kpss_cov_lags(), kpss_lag(), F.lit(0))))
        short = materialize(wanted.where(F.col("_need") >= F.size("s")).select(key, "_need"))
        if not short.limit(1).count():
            break
        more = sums.drop("s").join(lag_sums(sg.home_rows(d), short, key, kw.get("size", sg.DEFAULT_SEGMENT_ROWS)), key)
        sums = materialize(sums.join(short, key, "left_anti").unionByName(more))
    cols = sg.layout_columns(d) or [sg.POS]
    eta = sg.running_sum(d.select(key, "_e", *cols), "_e", "_S", key).groupBy(key).agg(
        F.sum(F.col("_S") * F.col("_S")).alias("_ss"))
    return kpss_from(sums, eta, key)


def kpss_from(sums: DataFrame, eta: DataFrame, key: str = "series_id") -> DataFrame:
    """The test from the autocovariance sums and ``eta`` (key, ``_ss``: sum of squared running sums)."""
    lagged = sums.withColumn("kpss_lags", kpss_lag())
    n = F.col("n").cast("double")
    l = F.col("kpss_lags")
    wsum = F.aggregate(F.sequence(F.lit(1), F.greatest(l, F.lit(1))),
                       F.lit(0.0), lambda acc, i: acc + F.when(i <= l, _s(i) * (1.0 - i / (l + 1.0))).otherwise(0.0))
    sig = F.when(l.isNotNull(), (_s(0) + 2.0 * wsum) / n)
    out = lagged.join(eta, key).select(key, "n", "kpss_lags", (F.col("s")[0] == 0).alias("_flat"), F.try_divide(F.col("_ss") / (n * n), sig).alias("kpss_stat"))
    crit, pv = solvers.KPSS_CRIT, solvers.KPSS_PVAL
    x = F.col("kpss_stat")
    p = F.when(x.isNull(), F.lit(None).cast("double")).when(x <= crit[0], pv[0])
    for i in range(3):
        p = p.when(x <= crit[i + 1], pv[i] + (x - crit[i]) * (pv[i + 1] - pv[i]) / (crit[i + 1] - crit[i]))
    reason = F.when(x.isNull(), F.when(F.col("_flat"), F.lit("constant series")).otherwise(F.lit("bandwidth beyond the lags that are kept")))
    return out.withColumn("kpss_pvalue", p.otherwise(pv[-1])).withColumn("kpss_reason", reason).drop("_flat")


def _levinson_udf(nlags: int, order: int, method: str = "adjusted"):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            s, n = np.asarray(r["s"], dtype=float), int(r["n"])
            k = np.arange(len(s))
            # 'adjusted': divisor n - k (the pacf default); 'mle': divisor n (the plotting default)
            gamma = s / np.maximum(n - k, 1) if method == "adjusted" else s / n
            pacf, _ = solvers.durbin_levinson(gamma[: nlags + 1])
            rho, s2 = solvers.yule_walker(gamma, order)
            out.append((r.iloc[0], n, [float(v) for v in pacf], [float(v) for v in rho], s2,
                        float(np.sqrt(s2)) if s2 > 0 else float("nan")))
        return pd.DataFrame(out, columns=["series_id", "n", "pacf", "ar_coef", "sigma2", "sigma"])
    return run


def pacf_yw(sums: DataFrame, nlags: int = 30, order: int = 4, key: str = "series_id", method: str = "adjusted") -> DataFrame:
    """T5 + T7: PACF (Yule-Walker by Durbin-Levinson on 'adjusted' autocovariances, divisor n - k,
    or 'mle', divisor n) and the AR(order) Yule-Walker fit with sigma^2 and sigma, per series.
    Input is one row of K+1 sums per series."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("pacf", T.ArrayType(T.DoubleType())), T.StructField("ar_coef", T.ArrayType(T.DoubleType())),
                           T.StructField("sigma2", T.DoubleType()), T.StructField("sigma", T.DoubleType())])
    return sums.select(key, "n", "s").groupBy(key).applyInPandas(_levinson_udf(nlags, order, method), schema)


def pacf_long(py: DataFrame, key: str = "series_id") -> DataFrame:
    return py.select(key, "n", F.posexplode("pacf").alias("lag", "pacf"))


# ---- seasonal decomposition ------------------------------------------------------------------------

def decompose_type(df: DataFrame, value: str = "close", key: str = "series_id") -> DataFrame:
    """Multiplicative only when every value is positive."""
    return sg.home_rows(df).groupBy(key).agg(F.bool_or(F.col(value) <= 0).alias("has_non_positive")).withColumn(
        "model", F.when(F.col("has_non_positive"), "additive").otherwise("multiplicative"))


def decompose(df: DataFrame, value: str = "close", period: int = 30, model: str = "additive", key: str = "series_id",
              ts: str = "ts", **kw) -> DataFrame:
    """Classical decomposition (centred moving average trend, seasonal phase means).

    ``model`` is additive, multiplicative, or auto: each series gets the model that T9 names for
    it (multiplicative only if all its values are positive).
    Trend: centred MA of ``period`` (2 x MA for even periods), null at both ends.
    Seasonal: mean of detrended values per phase (position mod period), centred to mean 0
    (additive) or 1 (multiplicative). Needs two full periods; multiplicative needs positive
    values, otherwise the component columns are null and ``reason`` says why."""
    h = period // 2
    x = F.col(value)
    cols = sg.layout_columns(df)
    df = reuse_input(df.select(key, ts, value, *cols))

    def trend(w):
        if period % 2 == 0:
            core = F.sum(x).over(w.rowsBetween(-(h - 1), h - 1))
            edge = 0.5 * (F.lag(x, h).over(w) + F.lead(x, h).over(w))
            return (core + edge) / float(period)
        return F.when(F.count(x).over(w.rowsBetween(-h, h)) == period, F.avg(x).over(w.rowsBetween(-h, h)))

    gate = sg.home_rows(df).groupBy(key).agg(F.count(x).alias("_n"), F.coalesce(F.bool_or(x <= 0), F.lit(False)).alias("_nonpos"))
    gate = sg._maybe_broadcast(gate.withColumn("_mult", ~F.col("_nonpos") if model == "auto" else F.lit(model.startswith("mult"))))
    mult = F.col("_mult")

    def per(a, b):
        return F.when(mult, safe_div(a, b)).otherwise(a - b)

    d = windowed(df.select(key, ts, value, *cols), [{"trend": trend}], before=h, after=h, key=key, ts=ts, keep_pos=True, **kw)
    d = d.withColumn("_phase", F.pmod(F.col(sg.POS) - 1, F.lit(period))).join(gate, key).withColumn("_det", per(x, F.col("trend")))
    pa = d.groupBy(key, "_phase", "_mult").agg(F.avg("_det").alias("_pa"))
    pa = pa.withColumn("seasonal", per(F.col("_pa"), F.avg("_pa").over(Window.partitionBy(key)))).drop("_mult", "_pa")
    out = d.join(sg._maybe_broadcast(pa), [key, "_phase"])
    reason = (F.when(F.col("_n") < 2 * period, F.lit(f"needs {2 * period} observations"))
               .when(mult & F.col("_nonpos"), F.lit("multiplicative needs positive values")))
    ok = reason.isNull()
    return out.select(key, ts, x.alias("observed"), F.when(ok, F.col("trend")).alias("trend"),
                      F.when(ok, F.col("seasonal")).alias("seasonal"), F.when(ok, per(F.col("_det"), F.col("seasonal"))).alias("resid"),
                      reason.alias("reason"), F.when(mult, "multiplicative").otherwise("additive").alias("model"))


def residual_anomalies(dec: DataFrame, z: float = 3.0, key: str = "series_id", ts: str = "ts") -> DataFrame:
    """Rows whose decomposition residual is more than ``z`` sample standard deviations from
    the series' mean residual."""
    dec = reuse_input(dec)
    st = dec.groupBy(key).agg(F.avg("resid").alias("_mr"), F.stddev_samp("resid").alias("_sr"))
    j = dec.join(sg._maybe_broadcast(st), key).withColumn("z_score", safe_div(F.col("resid") - F.col("_mr"), F.col("_sr")))
    return j.filter(F.abs(F.col("z_score")) > z).select(key, ts, "observed", "resid", "z_score")


def stationarity_verdict(adf_p, kpss_p) -> F.Column:
    """Both tests agree on stationarity / only ADF / only KPSS / neither; null when either
    test has no p-value."""
    a, k = F.col(adf_p) if isinstance(adf_p, str) else adf_p, F.col(kpss_p) if isinstance(kpss_p, str) else kpss_p
    return (F.when(a.isNull() | k.isNull() | F.isnan(a) | F.isnan(k), F.lit(None).cast("string"))
             .when((a < 0.05) & (k > 0.05), "stationary")
             .when(a < 0.05, "adf_only")
             .when(k > 0.05, "kpss_only")
             .otherwise("non_stationary"))
