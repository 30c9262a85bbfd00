import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from test_statistics import _frame
from tsforge.operators import arma, smoothing
from tsforge.operators.smoothing import _holt_grid


def _holt_errors(x, a, b, s0):
    l, t = s0
    e = []
    for xt in x:
        f = l + t
        e.append(xt - f)
        ln = a * xt + (1 - a) * (l + t)
        t = b * (ln - l) + (1 - b) * t
        l = ln
    return np.array(e), (l, t)


def _holt_best(x, ca=None, cb=None):
    best = None
    for a, b in zip(*_holt_grid(ca, cb)):
        e0, _ = _holt_errors(x, a, b, (0.0, 0.0))
        e1, _ = _holt_errors(x, a, b, (1.0, 0.0))
        e2, _ = _holt_errors(x, a, b, (0.0, 1.0))
        A = np.stack([e0 - e1, e0 - e2], 1)  # e(s0) = e0 - A s0
        s0, *_ = np.linalg.lstsq(A, e0, rcond=None)
        r = e0 - A @ s0
        sse = float(r @ r)
        if best is None or sse < best[0]:
            best = (sse, a, b, s0)
    return best


def test_holt_exact_scan_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    x = 50 + 0.3 * np.arange(150) + np.cumsum(rng.standard_normal(150))
    df = _frame(spark, {"s": x})
    fit = smoothing.holt_fit(df, "close", size=37, fan_in=2).collect()[0]  # 5 segments, 3 merge levels
    sse, a, b, s0 = _holt_best(x)
    sse, a, b, s0 = _holt_best(x, a, b)
    assert fit["alpha"] == pytest.approx(a) and fit["beta"] == pytest.approx(b)
    assert fit["sse"] == pytest.approx(sse, rel=1e-6)
    assert [fit["level0"], fit["trend0"]] == pytest.approx(list(s0), rel=1e-5, abs=1e-6)
    _, (l, t) = _holt_errors(x, a, b, s0)
    assert [fit["level"], fit["trend"]] == pytest.approx([l, t], rel=1e-7)
    fc = smoothing.holt_forecast(spark.createDataFrame([fit]), 3).orderBy("horizon").collect()
    assert fc[2]["forecast"] == pytest.approx(l + 3 * t, rel=1e-9)


def test_garch_recovers_parameters(spark):
    rng = np.random.default_rng(5)
    n, om, al, be = 3000, 0.05, 0.08, 0.87
    s2, eps = om / (1 - al - be), []
    for _ in range(n):
        e = np.sqrt(s2) * rng.standard_normal()
        eps.append(e)
        s2 = om + al * e * e + be * s2
    r = 0.02 + np.array(eps)
    close = 100 * np.cumprod(1 + r / 100)
    df = _frame(spark, {"g": np.r_[100.0, close]})
    fit_df = smoothing.garch_fit(df, "close", size=700).cache()
    fit = fit_df.collect()[0]
    assert fit["reason"] is None
    assert abs(fit["alpha"] - al) < 0.04 and abs(fit["beta"] - be) < 0.08
    # likelihood equals a direct evaluation of the recursion at the chosen parameters
    rr = np.diff(np.r_[100.0, close]) / np.r_[100.0, close][:-1] * 100
    e = rr - rr.mean()
    s = (e * e).mean()
    w = s * (1 - fit["alpha"] - fit["beta"])
    v, ll = s, 0.0
    for i, ei in enumerate(e):
        if i:
            v = w + fit["alpha"] * e[i - 1] ** 2 + fit["beta"] * v
        ll += -0.5 * (np.log(2 * np.pi) + np.log(v) + ei * ei / v)
    assert fit["loglik"] == pytest.approx(ll, rel=1e-9)
    assert fit["last_var"] == pytest.approx(v, rel=1e-9)
    f = smoothing.garch_forecast(fit_df, 30).orderBy("horizon").collect()
    assert f[-1]["variance"] == pytest.approx(s + (fit["alpha"] + fit["beta"]) ** 29 * (f[0]["variance"] - s), rel=1e-9)


def test_var_chooses_true_order(spark):
    rng = np.random.default_rng(2)
    A1 = np.array([[0.5, 0.1, 0.0], [0.0, 0.4, 0.1], [0.1, 0.0, 0.3]])
    A2 = np.array([[-0.2, 0.0, 0.1], [0.1, -0.2, 0.0], [0.0, 0.1, -0.2]])
    y = np.zeros((3000, 3))
    for t in range(2, 3000):
        y[t] = A1 @ y[t - 1] + A2 @ y[t - 2] + rng.standard_normal(3)
    base = pd.Timestamp("2000-01-01")
    rows = [("v", (base + pd.Timedelta(days=i)).date(), *map(float, y[i])) for i in range(3000)]
    df = spark.createDataFrame(rows, "series_id string, ts date, a double, b double, c double")
    out = arma.var_forecast(df, ["a", "b", "c"], 5, 30, size=450).toPandas()
    assert (out.lag_order == 2).all()
    import brute
    p, ref = brute.var_forecast(y, 5, 30)
    assert p == 2
    for j, v in enumerate(["a", "b", "c"]):
        mine = out[out.variable == v].sort_values("horizon").forecast.to_numpy()
        assert np.allclose(mine, ref[:, j], rtol=1e-7, atol=1e-9)
    one = out[out.horizon == 1].set_index("variable").forecast
    expect = A1 @ y[-1] + A2 @ y[-2]
    assert np.allclose(one[["a", "b", "c"]].to_numpy(), expect, atol=0.1)


def test_arima_hr_recovers_ar_and_ma(spark):
    rng = np.random.default_rng(9)
    n, e = 4000, rng.standard_normal(4001)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = 0.6 * x[t - 1] + e[t] + 0.4 * e[t - 1]
    df = _frame(spark, {"a": x + 10})
    out = arma.arima_hr(df, "close", p=1, horizon=30, size=900).orderBy("horizon").collect()
    assert out[0]["ar"][0] == pytest.approx(0.6, abs=0.05)
    assert out[0]["ma"] == pytest.approx(0.4, abs=0.07)
    assert out[-1]["forecast"] == pytest.approx(out[0]["const"] / (1 - out[0]["ar"][0]), rel=1e-2)


def test_arima_css_matches_brute_force_and_recovers(spark):
    rng = np.random.default_rng(9)
    n, e = 4000, rng.standard_normal(4001)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = 0.6 * x[t - 1] + e[t] + 0.4 * e[t - 1]
    df = _frame(spark, {"a": x + 10})
    out = arma.arima_css(df, "close", p=1, horizon=3, size=1000).orderBy("horizon").collect()  # 2 segments + halo
    xc = x + 10 - (x + 10).mean()
    best = None
    for th in arma.CSS_THETAS:
        w, prev = np.zeros(n), 0.0
        for t in range(n):
            prev = xc[t] - th * prev
            w[t] = prev
        Z, y = np.column_stack([np.ones(n - 1), w[:-1]]), w[1:]
        b = np.linalg.lstsq(Z, y, rcond=None)[0]
        sse = float(((y - Z @ b) ** 2).sum())
        if best is None or sse < best[0]:
            best = (sse, th, b)
    assert out[0]["ma"] == pytest.approx(best[1]) and out[0]["sse"] == pytest.approx(best[0], rel=1e-9)
    assert out[0]["ar"][0] == pytest.approx(best[2][1], rel=1e-9)
    assert abs(out[0]["ar"][0] - 0.6) < 0.05 and abs(out[0]["ma"] - 0.4) < 0.05


def test_arima_hr_equals_brute_force(spark):
    import brute
    rng = np.random.default_rng(21)
    n, e = 600, rng.standard_normal(601)
    x = np.zeros(n)
    for t in range(4, n):
        x[t] = 0.5 * x[t - 1] - 0.2 * x[t - 2] + 0.1 * x[t - 4] + e[t] + 0.3 * e[t - 1]
    df = _frame(spark, {"h": x + 50})
    out = arma.arima_hr(df, "close", 4, 10, size=150).orderBy("horizon").toPandas()
    ref, phi, theta = brute.arima_hr(x + 50, 4, 10)
    assert np.allclose(out.forecast.to_numpy(), ref, rtol=1e-7)
    assert np.allclose(out.ar.iloc[0], phi, rtol=1e-6) and out.ma.iloc[0] == pytest.approx(theta, rel=1e-6)
