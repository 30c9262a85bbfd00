import numpy as np
from pyspark.sql import functions as F
import pandas as pd
import pytest
from pyspark.sql import functions as F

import brute
from tsforge.operators import diagnostics, regression


def _frame(spark, series: dict[str, np.ndarray]):
    rows = []
    for sid, xs in series.items():
        base = pd.Timestamp("2000-01-01")
        rows += [(sid, (base + pd.Timedelta(days=i)).date(), float(v)) for i, v in enumerate(xs)]
    return spark.createDataFrame(rows, "series_id string, ts date, close double")


@pytest.fixture(scope="module")
def sims(spark):
    rng = np.random.default_rng(7)
    n = 400
    ar = np.zeros(n)
    e = rng.standard_normal(n)
    for t in range(4, n):
        ar[t] = 0.5 * ar[t - 1] - 0.3 * ar[t - 2] + 0.2 * ar[t - 3] + 0.1 * ar[t - 4] + e[t]
    series = {
        "noise": rng.standard_normal(n),
        "walk": np.cumsum(rng.standard_normal(n)) + 50,
        "ar4": ar,
        "short": rng.standard_normal(60),
    }
    return series, _frame(spark, series)


def test_adf_matches_brute_force(sims):
    series, df = sims
    out = {r["series_id"]: r for r in regression.adf(df, "close", size=97).collect()}
    for sid, x in series.items():
        tau, p, lag, nobs = brute.adf(x)
        assert out[sid]["used_lag"] == lag, sid
        assert out[sid]["nobs"] == nobs
        assert out[sid]["adf_stat"] == pytest.approx(tau, rel=1e-7, abs=1e-9)
        assert out[sid]["adf_pvalue"] == pytest.approx(p, rel=1e-6, abs=1e-12)
    assert out["walk"]["adf_pvalue"] > 0.05
    assert out["noise"]["adf_pvalue"] < 0.05


def test_kpss_matches_brute_force(sims):
    series, df = sims
    out = {r["series_id"]: r for r in diagnostics.kpss(df, "close", size=53).collect()}
    for sid, x in series.items():
        stat, p, lags = brute.kpss(x)
        assert out[sid]["kpss_lags"] == lags
        assert out[sid]["kpss_stat"] == pytest.approx(stat, rel=1e-9)
        assert out[sid]["kpss_pvalue"] == pytest.approx(p, rel=1e-9)
    assert out["noise"]["kpss_pvalue"] >= 0.05
    assert out["walk"]["kpss_pvalue"] < 0.05


def test_acf_pacf_ljung_box(sims):
    series, df = sims
    sums = diagnostics.autocov_sums(df, "close", 30, size=41)
    acf = diagnostics.acf(sums, 30).collect()
    got = {}
    for r in acf:
        got.setdefault(r["series_id"], {})[r["lag"]] = r["acf"]
    py = {r["series_id"]: r for r in diagnostics.pacf_yw(sums, 30, 4).collect()}
    pm = {r["series_id"]: r for r in diagnostics.pacf_yw(sums, 30, 4, method="mle").collect()}
    lb = {r["series_id"]: r for r in diagnostics.ljung_box(sums, 10).collect()}
    for sid, x in series.items():
        ref = brute.acf(x, 30)
        assert np.allclose([got[sid][k] for k in range(31)], ref, atol=1e-12)
        assert np.allclose(py[sid]["pacf"], brute.pacf_yw(x, 30), atol=1e-10)
        assert np.allclose(pm[sid]["pacf"], brute.pacf_yw(x, 30, adjusted=False), atol=1e-10)
        q, p = brute.ljung_box(x)
        assert lb[sid]["lb_stat"] == pytest.approx(q, rel=1e-10)
        assert lb[sid]["lb_pvalue"] == pytest.approx(p, rel=1e-8, abs=1e-300)
    # Yule-Walker AR(4) recovers the simulated coefficients
    assert np.allclose(py["ar4"]["ar_coef"], [0.5, -0.3, 0.2, 0.1], atol=0.15)
    assert py["ar4"]["sigma"] == pytest.approx(np.sqrt(py["ar4"]["sigma2"]))


def test_decomposition_adds_up(spark):
    rng = np.random.default_rng(3)
    t = np.arange(240)
    x = 10 + 0.05 * t + 2 * np.sin(2 * np.pi * t / 30) + 0.1 * rng.standard_normal(240)
    df = _frame(spark, {"s": x, "tiny": x[:50]})
    add = diagnostics.decompose(df, "close", 30, "additive", size=47).toPandas()
    s = add[add.series_id == "s"].sort_values("ts")
    ok = s.dropna(subset=["trend"])
    assert np.allclose(ok.trend + ok.seasonal + ok.resid, ok.observed)
    assert s.trend.isna().sum() == 30
    # numpy classical decomposition
    filt = np.r_[0.5, np.ones(29), 0.5] / 30
    tr = np.convolve(x, filt, mode="valid")
    assert np.allclose(s.trend.to_numpy()[15:-15], tr)
    det = x - np.r_[np.full(15, np.nan), tr, np.full(15, np.nan)]
    pa = np.array([np.nanmean(det[i::30]) for i in range(30)])
    pa -= pa.mean()
    assert np.allclose(s.seasonal.to_numpy(), np.tile(pa, 8))
    tiny = add[add.series_id == "tiny"]
    assert tiny.trend.isna().all() and (tiny.reason == "needs 60 observations").all()
    mult = diagnostics.decompose(df, "close", 30, "multiplicative").toPandas()
    m = mult[(mult.series_id == "s")].dropna(subset=["trend"])
    assert np.allclose(m.trend * m.seasonal * m.resid, m.observed)


def test_short_and_constant_series_do_not_fail(spark):
    """Every statistic and forecaster returns a row (possibly null) for series of 1-3 rows,
    a constant series and a series with zeros and negatives."""
    from tsforge.operators import arma, smoothing, summary
    rng = np.random.default_rng(1)
    series = {"one": np.array([5.0]), "two": np.array([5.0, 6.0]), "three": np.array([1.0, 2.0, 4.0]),
              "const": np.full(80, 3.0), "zeros_neg": rng.standard_normal(70), "n60": rng.standard_normal(60) + 10}
    df = _frame(spark, series)
    df = df.withColumn("open", df.close).withColumn("volume", df.close * 0 + 1)
    ids = set(series)
    assert {r[0] for r in regression.adf(df, "close").collect()} == ids
    assert {r[0] for r in diagnostics.kpss(df, "close").collect()} == ids
    assert {r[0] for r in diagnostics.ljung_box(diagnostics.autocov_sums(df, "close", 10)).collect()} == ids
    assert {r[0] for r in smoothing.garch_fit(df, "close").collect()} == ids
    assert {r[0] for r in arma.arima_hr(df, "close", 4, 5).collect()} == ids
    assert {r[0] for r in smoothing.holt_fit(df, "close").collect()} == ids
    assert {r[0] for r in summary.describe(df, "close").collect()} == ids
    c = {r["series_id"]: r for r in regression.adf(df, "close").collect()}
    assert c["const"]["adf_stat"] is None and c["one"]["adf_stat"] is None
    dec = diagnostics.decompose(df, "close", 30, "multiplicative").filter("series_id = 'zeros_neg'").collect()
    assert all(r["reason"] == "multiplicative needs positive values" and r["trend"] is None for r in dec)


def test_zero_divisions_yield_nulls_not_errors(spark):
    """ANSI mode raises on x/0: constant series, short series and zero values must give nulls."""
    from tsforge.operators import summary
    from tsforge.sources import bars as B
    rows = {"c": np.full(70, 3.0), "z": np.r_[np.zeros(35), np.ones(35)], "s5": np.arange(5.0)}
    df = _frame(spark, rows)
    k = {r["series_id"]: r for r in summary.kde(df, "close", grid=5).filter("grid_index = 0").collect()}
    assert k["c"]["density"] is None and k["s5"]["density"] is not None
    lb = {r["series_id"]: r for r in diagnostics.ljung_box(diagnostics.autocov_sums(df, "close", 10), 10).collect()}
    assert lb["s5"]["lb_stat"] is None and lb["s5"]["lb_reason"] is not None
    assert diagnostics.decompose(df, "close", 30, "multiplicative").count() == 145
    w = {r["series_id"]: r for r in B.walk(df.withColumn("close", F.col("close"))).groupBy("series_id").agg(F.max("close").alias("m")).collect()}
    assert w["c"]["m"] is None


def test_length_boundaries(spark):
    """A2 gate at 50 rows and the decomposition's two full periods (60 rows for period 30)."""
    from tsforge.operators import clean
    rng = np.random.default_rng(5)
    series = {f"n{k}": rng.standard_normal(k) + 10 for k in (49, 50, 59, 60)}
    df = _frame(spark, series)
    kept = {r[0] for r in clean.length_gate(df, 50).select("series_id").distinct().collect()}
    assert kept == {"n50", "n59", "n60"}
    dec = diagnostics.decompose(df, "close", 30, "additive").toPandas()
    for sid, g in dec.groupby("series_id"):
        if sid in ("n49", "n50", "n59"):
            assert g.trend.isna().all() and (g.reason == "needs 60 observations").all()
        else:
            assert g.reason.isna().all() and g.trend.notna().sum() == 30


def test_stationarity_verdict_categories(spark):
    rows = [(0.01, 0.10), (0.01, 0.01), (0.50, 0.10), (0.50, 0.01), (0.05, 0.05)]
    df = spark.createDataFrame(rows, "adf_p double, kpss_p double")
    got = [r[0] for r in df.select(diagnostics.stationarity_verdict("adf_p", "kpss_p")).collect()]
    assert got == ["stationary", "adf_only", "kpss_only", "non_stationary", "non_stationary"]


def test_mackinnon_p_matches_known_critical_values():
    from tsforge.functions.solvers import kpss_p, mackinnon_p
    assert mackinnon_p(-3.43) == pytest.approx(0.01, abs=0.001)
    assert mackinnon_p(-2.86) == pytest.approx(0.05, abs=0.002)
    assert mackinnon_p(-2.57) == pytest.approx(0.10, abs=0.003)
    assert mackinnon_p(3.0) == 1.0 and mackinnon_p(-20.0) == 0.0
    assert kpss_p(0.463) == pytest.approx(0.05) and kpss_p(0.1) == 0.10 and kpss_p(2.0) == 0.01


def test_chi_square_tail_closed_form(spark):
    from tsforge.functions.columns import chi2_sf_even
    df = spark.createDataFrame([(18.307,), (23.209,), (0.0,)], "q double")
    got = [r[0] for r in df.select(chi2_sf_even("q", 10)).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-4) and got[1] == pytest.approx(0.01, abs=1e-4) and got[2] == pytest.approx(1.0)


def test_undefined_statistics_are_null_with_a_reason(spark):
    rng = np.random.default_rng(2)
    df = _frame(spark, {"const": np.full(100, 0.1), "noise": rng.standard_normal(100)})
    k = {r["series_id"]: r for r in diagnostics.kpss(df, "close").collect()}
    assert k["const"]["kpss_lags"] is None and k["const"]["kpss_pvalue"] is None and k["const"]["kpss_reason"] == "constant series"
    assert k["noise"]["kpss_reason"] is None and k["noise"]["kpss_pvalue"] is not None
    a = {r["series_id"]: r for r in regression.adf(df, "close").collect()}
    assert a["const"]["adf_stat"] is None and a["const"]["adf_pvalue"] is None
    v = spark.createDataFrame([(None, 0.05), (0.01, None), (0.01, 0.1), (float("nan"), 0.1)], "a double, k double")
    assert [r[0] for r in v.select(diagnostics.stationarity_verdict("a", "k")).collect()] == [None, None, "stationary", None]


def test_kpss_bandwidth_beyond_the_first_lags(spark):
    """Series whose own bandwidth needs more lags than were summed at first get them alone."""
    rng = np.random.default_rng(4)
    x = np.cumsum(rng.standard_normal(3000))
    df = _frame(spark, {"walk": x, "noise": rng.standard_normal(500), "const": np.ones(60)})
    for size in (120, 200_000):
        got = {r["series_id"]: r for r in diagnostics.kpss(df, "close", max_lag=6, size=size).collect()}
        for sid, v in (("walk", x), ("noise", df.where("series_id = 'noise'").orderBy("ts").toPandas().close.to_numpy())):
            stat, p, lags = brute.kpss(v)
            assert got[sid]["kpss_lags"] == lags and got[sid]["kpss_stat"] == pytest.approx(stat, rel=1e-9)
        assert got["const"]["kpss_stat"] is None


def test_decomposition_by_each_series_own_model(spark):
    rng = np.random.default_rng(6)
    up = 10 + rng.random(120)
    df = _frame(spark, {"up": up, "signed": up - 10.5})
    auto = diagnostics.decompose(df, "close", 30, "auto").toPandas()
    assert auto.groupby("series_id").model.first().to_dict() == {"up": "multiplicative", "signed": "additive"}
    for sid, model in (("up", "multiplicative"), ("signed", "additive")):
        one = diagnostics.decompose(df.where(F.col("series_id") == sid), "close", 30, model).toPandas().sort_values("ts")
        mine = auto[auto.series_id == sid].sort_values("ts")
        assert np.allclose(one.resid.to_numpy(float), mine.resid.to_numpy(float), equal_nan=True)


def test_quantiles_of_ties_outliers_and_few_values(spark):
    from tsforge.operators import summary
    rng = np.random.default_rng(7)
    series = {"ties": rng.integers(0, 3, 500).astype(float), "outlier": np.r_[rng.standard_normal(400), 1e12], "one": np.array([4.0]),
              "spread": rng.standard_normal(700)}
    df = _frame(spark, series)
    for rank_values, cells in ((200_000, 1000), (5, 7)):
        got = {(r["series_id"], r["q"]): r["value"] for r in
               summary.exact_quantiles(df, "close", [0.0, 0.25, 0.5, 0.99], rank_values=rank_values, cells=cells).collect()}
        for sid, x in series.items():
            for q in (0.0, 0.25, 0.5, 0.99):
                assert got[sid, q] == pytest.approx(np.quantile(x, q), rel=1e-12), (sid, q)


def test_histogram_has_its_empty_bins_and_kde_follows_the_definition(spark):
    from tsforge.operators import summary
    rng = np.random.default_rng(8)
    series = {"gap": np.array([0.0, 0.1, 10.0]), "noise": np.r_[rng.standard_normal(300), 40.0], "const": np.full(9, 2.0)}
    df = _frame(spark, series)
    h = summary.histogram(df, "close", bins=5).toPandas().sort_values(["series_id", "bin"])
    assert h[h.series_id == "gap"]["count"].tolist() == [2, 0, 0, 0, 1] and len(h[h.series_id == "const"]) == 5
    k = summary.kde(df, "close", grid=50).toPandas().sort_values(["series_id", "grid_index"])
    for sid in ("gap", "noise"):
        x = series[sid]
        bw = x.std(ddof=1) * len(x) ** -0.2
        g = np.linspace(x.min(), x.max(), 50)
        want = np.exp(-0.5 * ((g[:, None] - x) / bw) ** 2).sum(1) / (len(x) * bw * np.sqrt(2 * np.pi))
        assert np.allclose(k[k.series_id == sid].density, want, rtol=1e-6, atol=1e-12)
    assert k[k.series_id == "const"].density.isna().all()
