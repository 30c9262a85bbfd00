"""Forecast evaluation and model selection.

Forecasts live in one long table ``series_id, model, ts, horizon, actual, forecast``.
All metrics of all (series, model) pairs come from one grouped aggregation plus one exact
median; rankings use window functions over the small metrics table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.columns import safe_div
from tsforge.operators.splits import holdout_tail
from tsforge.operators.summary import exact_quantiles
from tsforge.session import reuse_input

METRICS = ["rmse", "mse", "mae", "mape", "r2", "medae", "msle"]
HIGHER_IS_BETTER = {"r2"}


def align(forecasts: DataFrame, actuals: DataFrame, on=("series_id", "horizon")) -> DataFrame:
    """Pair forecasts with actuals by (series, horizon) instead of array position.

    ``actuals`` carries ``ts`` and ``actual`` (e.g. ``holdout_tail`` test rows)."""
    return forecasts.join(actuals, list(on), "inner")


def union_forecasts(frames: dict[str, DataFrame]) -> DataFrame:
    """O4 + S3: union forecast tables whose columns differ; the dict key becomes ``model``."""
    out = None
    for name, f in frames.items():
        f = f.withColumn("model", F.lit(name))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def tail_per_model(df: DataFrame, h: int = 30, models_like: tuple = ("arima", "exp_smoothing"),
                   key=("series_id", "model"), ts="ts") -> DataFrame:
    """Keep only the last ``h`` rows of models whose lower-cased name contains one of
    ``models_like``; other models keep all rows."""
    m = F.lower(F.col("model"))
    sel = None
    for s in models_like:
        sel = m.contains(s) if sel is None else (sel | m.contains(s))
    tail = holdout_tail(df.filter(sel), h, key=list(key), ts=ts).filter("is_test").drop("is_test", "horizon")
    return df.filter(~sel).unionByName(tail)


def forecast_metrics(fc: DataFrame, key=("series_id", "model"), a="actual", f="forecast") -> DataFrame:
    """RMSE, MSE, MAE, R2, MAPE and MedAE (all rows / positive pairs), MSLE per group.

    R2 = 1 - SSE / (var_pop(actual) * n). MAPE ignores rows with a zero actual (division is
    null); ``mape_pos`` and ``msle`` use rows with actual > 0 and forecast > 0 only, and MSLE
    is null when there is none."""
    keys = list(key)
    d = reuse_input(fc.filter(F.col(a).isNotNull() & F.col(f).isNotNull()))
    e = F.col(a) - F.col(f)
    pos = (F.col(a) > 0) & (F.col(f) > 0)
    ape = F.abs(safe_div(e, F.col(a)))
    agg = d.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        (1.0 - safe_div(F.sum(e * e), F.var_pop(a) * F.count(F.lit(1)))).alias("r2"),
        (100.0 * F.avg(ape)).alias("mape"),
        (100.0 * F.avg(F.when(pos, ape))).alias("mape_pos"),
        F.avg(F.when(pos, F.pow(F.log1p(F.col(a)) - F.log1p(F.col(f)), 2))).alias("msle"),
    ).withColumn("rmse", F.sqrt("mse"))
    med = exact_quantiles(d.withColumn("_ae", F.abs(e)), "_ae", [0.5], keys).select(*keys, F.col("value").alias("medae"))
    med_pos = exact_quantiles(d.filter(pos).withColumn("_ae", F.abs(e)), "_ae", [0.5], keys).select(
        *keys, F.col("value").alias("medae_pos"))
    return agg.join(med, keys, "left").join(med_pos, keys, "left")


def metrics_long(metrics: DataFrame, key=("series_id", "model"), names=tuple(METRICS)) -> DataFrame:
    return metrics.unpivot(list(key), list(names), "metric", "value")


def leaderboard(metrics: DataFrame, key="series_id", names=tuple(METRICS)) -> DataFrame:
    """M9: rank of every model per (series, metric); R2 ranks descending, errors ascending."""
    lg = metrics_long(metrics, (key, "model"), names).filter(F.col("value").isNotNull())
    score = F.when(F.col("metric").isin(*HIGHER_IS_BETTER), -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy(key, "metric").orderBy(score)
    return lg.withColumn("rank", F.rank().over(w).cast("int"))


def win_share(metrics: DataFrame, key="series_id", names=tuple(METRICS)) -> DataFrame:
    """Share of pairwise comparisons each model wins, over all metrics and opponents;
    a tie counts one half. Counted from ranks (models strictly worse, ties), so no pairs are
    materialised."""
    lg = metrics_long(metrics, (key, "model"), names).filter(F.col("value").isNotNull())
    score = F.when(F.col("metric").isin(*HIGHER_IS_BETTER), -F.col("value")).otherwise(F.col("value"))
    lg = lg.withColumn("_s", score)
    grp = Window.partitionBy(key, "metric")
    upto = grp.orderBy("_s").rangeBetween(Window.unboundedPreceding, 0)
    tie = Window.partitionBy(key, "metric", "_s")
    m = F.count(F.lit(1)).over(grp)
    worse = m - F.count(F.lit(1)).over(upto)
    ties = F.count(F.lit(1)).over(tie) - 1
    per = lg.withColumn("_m", m).withColumn("_wins", worse + 0.5 * ties)
    return (per.filter(F.col("_m") > 1).groupBy(key, "model")
               .agg((F.sum("_wins") / F.sum(F.col("_m") - 1)).alias("win_share"),
                    F.count(F.lit(1)).cast("bigint").alias("n_metrics")))


def best_model(metrics: DataFrame, key="series_id", by="rmse") -> DataFrame:
    """Model with the lowest ``by`` per series (ties broken by model name)."""
    return metrics.filter(F.col(by).isNotNull()).groupBy(key).agg(
        F.min_by("model", F.struct(F.col(by), F.col("model"))).alias("best_model"),
        F.min(by).alias(f"best_{by}"))


def format_metrics(metrics: DataFrame, decimals: dict[str, int] | None = None) -> DataFrame:
    """Metric values as fixed-decimal text for reports (``1,234.5678``); MAPE gets a % sign."""
    decimals = decimals or {"rmse": 4, "mse": 4, "mae": 4, "r2": 4, "mape": 2, "medae": 4, "msle": 4}
    cols = {}
    for k, d in decimals.items():
        if k in metrics.columns:
            txt = F.format_number(F.col(k), d)
            cols[f"{k}_text"] = F.concat(txt, F.lit("%")) if k == "mape" else txt
    return metrics.withColumns(cols)
