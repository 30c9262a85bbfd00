"""Plain numpy versions of the per-series statistics, written from the published formulas,
used as the oracle for the Spark jobs on small series."""

import math

import numpy as np

from tsforge.functions.solvers import kpss_p, mackinnon_p


def lagmat_rows(x, p):
    """Rows of the ADF regression with lag p on the sample starting at diff index start."""
    dx = np.diff(x)
    return dx


def adf(x):
    x = np.asarray(x, float)
    n = len(x)
    pmax = min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    dx = np.diff(x)

    def design(p, start):
        rows = range(start, n)  # j = index of x whose difference is the response
        X = [[1.0, x[j - 1]] + [dx[j - 1 - i] for i in range(1, p + 1)] for j in rows]
        y = [dx[j - 1] for j in rows]
        return np.array(X), np.array(y)

    best = None
    for p in range(pmax + 1):
        X, y = design(p, pmax + 1)
        b, *_ = np.linalg.lstsq(X, y, rcond=None)
        ssr = float(((y - X @ b) ** 2).sum())
        nobs = len(y)
        aic = nobs * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1) + 2 * X.shape[1]
        if best is None or aic < best[0]:
            best = (aic, p)
    p = best[1]
    X, y = design(p, p + 1)
    b, *_ = np.linalg.lstsq(X, y, rcond=None)
    r = y - X @ b
    s2 = (r @ r) / (len(y) - X.shape[1])
    cov = s2 * np.linalg.inv(X.T @ X)
    tau = b[1] / math.sqrt(cov[1, 1])
    return tau, mackinnon_p(tau), p, len(y)


def kpss(x):
    e = np.asarray(x, float) - np.mean(x)
    n = len(e)
    m = int(n ** (2 / 9))
    s0 = (e @ e) / n
    s1 = 0.0
    for i in range(1, m + 1):
        c = (e[i:] @ e[:-i]) / (n / 2)
        s0 += c
        s1 += i * c
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    s = e @ e
    for i in range(1, lags + 1):
        s += 2 * (e[i:] @ e[:-i]) * (1 - i / (lags + 1))
    stat = (np.cumsum(e) ** 2).sum() / n ** 2 / (s / n)
    return stat, kpss_p(stat), lags


def acf(x, k):
    e = np.asarray(x, float) - np.mean(x)
    d = e @ e
    return np.array([1.0] + [(e[i:] @ e[:-i]) / d for i in range(1, k + 1)])


def pacf_yw(x, k, adjusted=True):
    e = np.asarray(x, float) - np.mean(x)
    n = len(e)
    g = np.array([(e @ e) / n] + [(e[i:] @ e[:-i]) / ((n - i) if adjusted else n) for i in range(1, k + 1)])
    out = [1.0]
    for p in range(1, k + 1):
        T = np.array([[g[abs(i - j)] for j in range(p)] for i in range(p)])
        out.append(np.linalg.solve(T, g[1:p + 1])[-1])
    return np.array(out)


def ljung_box(x, lags=10):
    n = len(x)
    r = acf(x, lags)
    q = n * (n + 2) * sum(r[k] ** 2 / (n - k) for k in range(1, lags + 1))
    h = q / 2
    p = math.exp(-h) * sum(h ** j / math.factorial(j) for j in range(lags // 2))
    return q, p


def var_forecast(y, pmax=5, h=30):
    """VAR with constant: standardise columns, lag order by AIC (ln det Sigma + 2(p m^2 + m)/T)
    on the common sample, refit with that order on its longer sample, h-step forecast."""
    y = np.asarray(y, float)
    mu, sd = y.mean(0), y.std(0)
    sd[sd == 0] = 1.0
    z = (y - mu) / sd
    n, m = z.shape

    def design(p, start):
        X = [np.r_[1.0, np.concatenate([z[t - i] for i in range(1, p + 1)])] if p else np.array([1.0]) for t in range(start, n)]
        return np.array(X), z[start:]

    best = None
    for p in range(pmax + 1):
        X, Y = design(p, pmax)
        B = np.linalg.lstsq(X, Y, rcond=None)[0]
        E = Y - X @ B
        aic = np.linalg.slogdet(E.T @ E / len(Y))[1] + 2.0 * (p * m * m + m) / len(Y)
        if best is None or aic < best[0]:
            best = (aic, p)
    p = best[1]
    X, Y = design(p, p)
    B = np.linalg.lstsq(X, Y, rcond=None)[0]
    hist = list(z[-pmax:]) if pmax else []
    out = []
    for _ in range(h):
        x = np.r_[1.0, np.concatenate([hist[-i] for i in range(1, p + 1)])] if p else np.array([1.0])
        f = x @ B
        hist.append(f)
        out.append(f * sd + mu)
    return p, np.array(out)


def arima_hr(x, p=4, h=30, max_long_ar=60):
    """Hannan-Rissanen ARIMA(p,0,1): centred series, AR(m) residuals with
    m = min(max_long_ar, max(floor(ln(n)^2), 2p), floor((n-2)/3)), then x_t on 1, p lags and the
    lagged residual; h-step forecast."""
    x = np.asarray(x, float)
    n = len(x)
    mu = x.mean()
    xc = x - mu
    m = int(min(max_long_ar, max(math.floor(math.log(n) ** 2), 2 * p), math.floor((n - 2) / 3)))
    X1 = np.array([np.r_[1.0, xc[t - m:t][::-1]] for t in range(m, n)])
    b1 = np.linalg.lstsq(X1, xc[m:], rcond=None)[0]
    e = np.full(n, np.nan)
    e[m:] = xc[m:] - X1 @ b1
    rows = [t for t in range(m + 1, n)]
    X2 = np.array([np.r_[1.0, xc[t - p:t][::-1], e[t - 1]] for t in rows])
    b2 = np.linalg.lstsq(X2, xc[rows], rcond=None)[0]
    e2 = xc[n - 1] - np.r_[1.0, xc[n - 1 - p:n - 1][::-1], e[n - 2]] @ b2
    const, phi, theta = b2[0], b2[1:p + 1], b2[p + 1]
    hist = list(xc[-p:])
    out = []
    for k in range(1, h + 1):
        f = const + sum(phi[i] * hist[-1 - i] for i in range(p)) + (theta * e2 if k == 1 else 0.0)
        hist.append(f)
        out.append(f + mu)
    return np.array(out), phi, theta
