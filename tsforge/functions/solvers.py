"""Small closed-form solvers used inside per-series ``applyInPandas`` steps.

Inputs are bounded per series (a few dozen autocovariances or a k x k Gram matrix), never
the series itself.
"""

from __future__ import annotations

import math

import numpy as np

# MacKinnon (1994) response-surface coefficients for the Dickey-Fuller
# tau statistic, constant-only regression, one variable (N = 1).
TAU_MAX_C = 2.74
TAU_MIN_C = -18.83
TAU_STAR_C = -1.61
TAU_C_SMALLP = (2.1659, 1.4412, 0.038269)
TAU_C_LARGEP = (1.7339, 0.93202, -0.12745, -0.010368)

# KPSS level-stationarity critical values and their p-values
# (Kwiatkowski et al. 1992, table 1, eta_mu).
KPSS_CRIT = (0.347, 0.463, 0.574, 0.739)
KPSS_PVAL = (0.10, 0.05, 0.025, 0.01)


def norm_cdf(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def mackinnon_p(tau: float) -> float:
    """Asymptotic p-value of the ADF statistic, constant only."""
    if not np.isfinite(tau):
        return float("nan")
    if tau > TAU_MAX_C:
        return 1.0
    if tau < TAU_MIN_C:
        return 0.0
    coef = TAU_C_SMALLP if tau <= TAU_STAR_C else TAU_C_LARGEP
    return norm_cdf(sum(c * tau ** i for i, c in enumerate(coef)))


def kpss_p(stat: float) -> float:
    """Linear interpolation in the KPSS table, clamped to [0.01, 0.10]."""
    return float(np.interp(stat, KPSS_CRIT, KPSS_PVAL))


def durbin_levinson(gamma: np.ndarray) -> tuple[np.ndarray, float]:
    """Partial autocorrelations from autocovariances gamma[0..K] (Durbin-Levinson).

    Returns (pacf[0..K] with pacf[0] = 1, innovation variance after K steps). Like solving each
    order's Toeplitz system directly, it keeps going when the 'adjusted' autocovariances are
    not positive definite (values can then leave [-1, 1])."""
    k_max = len(gamma) - 1
    pacf = np.full(k_max + 1, np.nan)
    pacf[0] = 1.0
    if gamma[0] <= 0 or not np.isfinite(gamma[0]):
        return pacf, float("nan")
    phi = np.zeros(0)
    v = gamma[0]
    for k in range(1, k_max + 1):
        if v == 0 or not np.isfinite(v):
            break  # singular system: the remaining orders are undefined
        num = gamma[k] - (phi @ gamma[k - 1:0:-1] if k > 1 else 0.0)
        a = num / v
        phi = np.concatenate([phi - a * phi[::-1], [a]])
        v = v * (1.0 - a * a)
        pacf[k] = a
    return pacf, v


def yule_walker(gamma: np.ndarray, order: int) -> tuple[np.ndarray, float]:
    """AR(order) coefficients from autocovariances by the Toeplitz solve; returns (rho, sigma^2)."""
    r = np.asarray(gamma[: order + 1], dtype=float)
    idx = np.abs(np.arange(order)[:, None] - np.arange(order)[None, :])
    try:
        rho = np.linalg.solve(r[idx], r[1:])
    except np.linalg.LinAlgError:
        return np.full(order, np.nan), float("nan")
    return rho, float(r[0] - r[1:] @ rho)


def ols_from_gram(xtx: np.ndarray, xty: np.ndarray, yty: float):
    """Least squares from sufficient statistics. Returns (beta, ssr, inverse of X'X).

    Regressors that are identically zero (diagonal 0: lags a series does not use) get a zero
    coefficient and are left out of the solve."""
    k = xtx.shape[0]
    act = np.flatnonzero(np.diag(xtx) > 0)
    inv = np.zeros((k, k))
    beta = np.zeros(k)
    if len(act):
        sub = xtx[np.ix_(act, act)]
        try:
            isub = np.linalg.inv(sub)
        except np.linalg.LinAlgError:
            isub = np.linalg.pinv(sub)
        inv[np.ix_(act, act)] = isub
        beta[act] = isub @ xty[act]
    ssr = float(yty - beta @ xty)
    return beta, max(ssr, 0.0), inv
