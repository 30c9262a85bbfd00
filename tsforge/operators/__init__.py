"""Operators over DataFrames keyed by ``(series_id, ts)``.

segments     positions and bounded segments with halo rows (the scaling primitive)
clean        projection, filters, null handling, length gate, missing report
features     window features: differences, returns, rolling mean/std, EMA, up ratio, lag windows,
             back-fill, min-max scaling
splits       ordered holdouts (tail, fraction, validation tail) and the hash split
summary      describe with exact quantiles, histogram, binned kernel density
diagnostics  autocovariance sums, ACF/PACF, bands, Ljung-Box, KPSS, Yule-Walker, decomposition,
             anomalies, stationarity verdict
regression   partial-Gram least squares and the ADF test
smoothing    Holt and GARCH fits by exact segmented scans
arma         ARIMA(p,0,1) (CSS profiled over theta; Hannan-Rissanen) and VAR
baselines    last value, drift and 5-row mean yardsticks
evaluate     forecast metrics, leaderboard, win shares, best model, forecast unions
ml           Spark ML feature sets, tree/linear models, window regression, random search,
             permutation importance
neural       data-parallel dense network
"""
