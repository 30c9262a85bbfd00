"""Reference forecasters used as yardsticks: last value, drift and a 5-row mean.

One-step-ahead forecasts from lagged values of the same series, computed on the segmented
window layout (30 rows of look-back at most)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators.features import windowed


def one_step_baselines(bars: DataFrame, value: str = "close", drift_span: int = 30, **kw) -> DataFrame:
    """Adds ``naive`` (previous value), ``drift`` (previous value plus the mean of the last
    ``drift_span - 1`` differences) and ``mean5`` (mean of the 5 previous values)."""
    v = F.col(value)
    steps = [{
        "naive": lambda w: F.lag(v, 1).over(w),
        "drift": lambda w: F.lag(v, 1).over(w) + (F.lag(v, 1).over(w) - F.lag(v, drift_span).over(w)) / float(drift_span - 1),
        "mean5": lambda w: F.when(F.count(v).over(w.rowsBetween(-5, -1)) == 5, F.avg(v).over(w.rowsBetween(-5, -1))),
    }]
    return windowed(bars, steps, before=drift_span, **kw)


def baseline_forecasts(bars: DataFrame, holdout: int = 30, value: str = "close", **kw) -> DataFrame:
    """Long forecast table of the three baselines over the last ``holdout`` rows of each series."""
    from tsforge.operators.splits import holdout_tail
    b = holdout_tail(one_step_baselines(bars, value, **kw), holdout).filter("is_test")
    lg = b.unpivot(["series_id", "ts", "horizon", value], ["naive", "drift", "mean5"], "model", "forecast")
    return lg.select("series_id", "model", "ts", "horizon", F.col(value).alias("actual"), "forecast")
