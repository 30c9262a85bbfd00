"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables. Computed columns are rounded and aliased exactly like the oracle SQL in
``plans/oracle.py`` (doubles that can differ in the last bits between engines are rounded to
4 decimals at price scale and 6-8 decimals at unit scale)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.operators import (baselines, boosting, clean, diagnostics, evaluate, features as fe, incremental, layout, ml, neural, ranks, regression, smoothing,
                               splits, summary)
from tsforge.plans import forecasting
from tsforge.session import checkpoint_dir, materialize
from tsforge.sources import bars as B, files, sinks
from tsforge.streaming import bars as live, scoring

QUERIES: dict = {}


def query(name):
    def reg(fn):
        QUERIES[name] = fn
        return fn
    return reg


def r(col, d=6):
    return F.round(F.col(col), d).alias(col)


# ---- step 1: bars, extraction, cleaning -------------------------------------------------------

@query("series_summary")
def series_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: bars -> log return, SMA 5/20, 30-row mean/std, EMA 10 -> per-series summary."""
    f = fe.technical_features(B.bars_orders(spark, sf))
    return f.groupBy("series_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_bars"),
        F.round(F.avg("log_return"), 8).alias("mean_log_return"),
        F.round(F.stddev_samp("log_return"), 8).alias("volatility"),
        F.round(F.max_by("sma_5", "ts"), 4).alias("last_sma_5"),
        F.round(F.max_by("sma_20", "ts"), 4).alias("last_sma_20"),
        F.round(F.max_by("roll_std_30", "ts"), 4).alias("last_roll_std_30"),
        F.round(F.max_by("ema_10", "ts"), 4).alias("last_ema_10"),
    )


@query("bars_daily")
def bars_daily(spark, sf):
    return B.bars_orders(spark, sf)


@query("bars_many")
def bars_many(spark, sf):
    return B.bars_many(spark, sf)


@query("bars_lineitem")
def bars_lineitem(spark, sf):
    return B.bars_lineitem(spark, sf)


@query("bars_hourly_events")
def bars_hourly_events(spark, sf):
    return B.bars_events(spark, sf, "hour")


@query("bars_walk")
def bars_walk(spark, sf):
    return B.bars_walk(spark, sf)


@query("extract_series")
def extract_series(spark, sf):
    return clean.extract_series(B.bars_orders(spark, sf), "1-URGENT", drop=("volume",))


@query("missing_report")
def missing_report(spark, sf):
    f = fe.technical_features(B.bars_orders(spark, sf))
    return clean.missing_report(f, cols=["close", "log_return", "sma_5", "sma_20", "roll_std_30", "rsi_14"]).select(
        "series_id", F.col("n_rows").cast("bigint"), "column", F.col("n_null").cast("bigint"))


@query("series_length_gate")
def series_length_gate(spark, sf):
    """A2 over many series: 25 order/segment series and 5 daily event series (30 rows)."""
    many = B.bars_many(spark, sf).select("series_id", "ts", "close")
    ev = B.bars_events(spark, sf, "day").select(F.concat(F.lit("events|"), "series_id").alias("series_id"), "ts", "close")
    allb = many.unionByName(ev.withColumn("ts", F.to_date("ts")))
    n = clean.series_lengths(allb)
    kept = clean.length_gate(allb, 50).groupBy("series_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_kept"))
    return n.join(kept, "series_id", "left").select(
        "series_id", F.col("n").alias("n_rows"), F.coalesce("n_kept", F.lit(0)).cast("bigint").alias("n_kept"),
        (F.col("n") >= 50).alias("passed"))


# ---- step 2: window features ---------------------------------------------------------------------

@query("first_difference")
def first_difference(spark, sf):
    return fe.first_difference(B.bars_orders(spark, sf)).select("series_id", "ts", r("diff", 4))


@query("log_returns")
def log_returns(spark, sf):
    return fe.log_returns(B.bars_orders(spark, sf)).select("series_id", "ts", r("log_return", 8))


@query("pct_change")
def pct_change(spark, sf):
    return fe.pct_changes(B.bars_orders(spark, sf)).select("series_id", "ts", r("pct_change", 6))


@query("rolling_mean")
def rolling_mean(spark, sf):
    return fe.rolling(B.bars_orders(spark, sf), windows=(5, 20, 30), std_windows=()).select(
        "series_id", "ts", r("sma_5", 4), r("sma_20", 4), r("sma_30", 4))


@query("rolling_std")
def rolling_std(spark, sf):
    return fe.rolling(B.bars_orders(spark, sf), windows=(), std_windows=(30,)).select("series_id", "ts", r("std_30", 3))


@query("ema10")
def ema10(spark, sf):
    return fe.ema_feature(B.bars_orders(spark, sf), span=10).select("series_id", "ts", r("ema_10", 4))


@query("rsi14")
def rsi14(spark, sf):
    return fe.rsi(B.bars_orders(spark, sf)).select("series_id", "ts", r("rsi_14", 8))


@query("backfill")
def backfill(spark, sf):
    """Warm-up nulls of SMA 5/20 and the up ratio filled from the next valid row."""
    f = fe.technical_features(B.bars_orders(spark, sf)).select("series_id", "ts", "sma_5", "sma_20", "rsi_14")
    return fe.backfill(f, ["sma_5", "sma_20", "rsi_14"]).select("series_id", "ts", r("sma_5", 4), r("sma_20", 4), r("rsi_14", 8))


@query("minmax_scale")
def minmax_scale(spark, sf):
    """Scaler fitted on training rows only (all but the last 30 of each series)."""
    b = splits.holdout_tail(B.bars_orders(spark, sf), 30).withColumn("is_train", ~F.col("is_test"))
    return fe.minmax_scale(b, "close", train_col="is_train").select("series_id", "ts", "is_test", r("scaled", 8))


@query("minmax_roundtrip")
def minmax_roundtrip(spark, sf):
    """inverse(scale(x)) recovers x; the largest error per series, rounded."""
    s = fe.minmax_inverse(fe.minmax_scale(B.bars_orders(spark, sf), "close", train_col=None))
    return s.groupBy("series_id").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                      F.round(F.max(F.abs(F.col("unscaled") - F.col("close"))), 6).alias("max_abs_err"))


@query("lag_sequences")
def lag_sequences(spark, sf):
    return fe.lag_sequences(B.bars_orders(spark, sf), lookback=20).select("series_id", "ts", "lags", "target")


@query("sequence_wide")
def sequence_wide(spark, sf):
    s = fe.lag_sequences(B.bars_orders(spark, sf), lookback=20).select("series_id", "ts", "lags", "target")
    return fe.widen(s, "lags", "feature_", 20)


@query("holdout_tail")
def holdout_tail(spark, sf):
    t = splits.holdout_tail(B.bars_orders(spark, sf), 30)
    return t.filter("is_test").select("series_id", "ts", "horizon", "close")


@query("holdout_fraction")
def holdout_fraction(spark, sf):
    t = splits.holdout_fraction(B.bars_orders(spark, sf), 0.8, 0.1)
    return t.select("series_id", "ts", "split")


# ---- summary statistics --------------------------------------------------------------------------

@query("describe")
def describe(spark, sf):
    d = summary.describe(B.bars_orders(spark, sf), "close")
    return d.select("series_id", "count", r("mean", 4), r("std", 3), r("min", 4), r("p25", 4), r("p50", 4),
                    r("p75", 4), r("max", 4))


@query("histogram")
def histogram(spark, sf):
    h = summary.histogram(B.bars_orders(spark, sf), "close", bins=20)
    return h.select("series_id", "bin", r("lo_edge", 4), r("hi_edge", 4), "count")


def _edge_values(spark, sf):
    """Bars with marks on some rows: an infinite value on the first of each series of 1-URGENT and 2-HIGH,
    NaN on every fifth of 3-MEDIUM, one outlier in 4-NOT SPECIFIED, a constant 5-LOW."""
    b = B.bars_orders(spark, sf).select("series_id", "ts", "close")
    first = b.groupBy("series_id").agg(F.min("ts").alias("first"))
    sid, one = F.col("series_id"), F.col("ts") == F.col("first")
    v = (F.when(one & (sid == "1-URGENT"), F.lit(float("inf"))).when(one & (sid == "2-HIGH"), F.lit(float("-inf")))
          .when((sid == "3-MEDIUM") & (F.dayofmonth("ts") % 5 == 0), F.lit(float("nan")))
          .when(one & (sid == "4-NOT SPECIFIED"), F.lit(1e12)).when(sid == "5-LOW", F.lit(7.25)).otherwise(F.col("close")))
    return b.join(first, "series_id").select("series_id", "ts", v.alias("close"))


@query("naive_utc")
def naive_utc(spark, sf):
    """Zoned timestamp text of events (two offsets) as naive UTC time."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    off = F.when(F.col("event_id") % 2 == 0, "+02:00").otherwise("-05:30")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), off)
    return clean.to_naive_utc(e.select("event_id", text.alias("Date")), "Date", "utc").select("event_id", "utc")


@query("preview_rows")
def preview_rows(spark, sf):
    """The first rows in order of series and date."""
    return files.preview(B.bars_orders(spark, sf).select("series_id", "ts", r("close", 4)), ["series_id", "ts"], 5)


@query("formatted_metrics")
def formatted_metrics(spark, sf):
    """Metrics as text with fixed decimals."""
    m = evaluate.format_metrics(_baseline_metrics(spark, sf), {"rmse": 3, "mae": 3, "r2": 6, "mape": 4})
    return m.select("series_id", "model", "rmse_text", "mae_text", "r2_text", "mape_text")


@query("dropped_rows")
def dropped_rows(spark, sf):
    """P8/P9 + P10: technical features without warm-up rows, and positive pairs of close and difference."""
    f = fe.windowed(B.bars_orders(spark, sf), [{"diff": fe.diff("close"), "sma_20": fe.rolling_mean("close", 20)}], before=20)
    whole = clean.dropna_subset(f, ["diff", "sma_20"])
    pos = clean.positive_pairs(whole, "close", "diff")
    return whole.groupBy("series_id").agg(F.count(F.lit(1)).alias("whole")).join(pos.groupBy("series_id").agg(F.count(F.lit(1)).alias("positive")), "series_id")


@query("describe_edge")
def describe_edge(spark, sf):
    """A4 over infinite, missing and outlying values."""
    d = summary.describe(_edge_values(spark, sf), "close")
    limits = [F.when(F.abs(F.col(c)) < float("inf"), F.round(F.col(c), 4)).alias(c) for c in ("min", "p25", "p50", "p75", "max")]
    return d.select("series_id", "count", r("mean", 2), r("std", 1), *limits, F.signum(F.when(F.abs("min") == float("inf"), F.col("min"))).cast("int").alias("low"),
                    F.signum(F.when(F.abs("max") == float("inf"), F.col("max"))).cast("int").alias("high"))


@query("histogram_edge")
def histogram_edge(spark, sf):
    """A5 by the automatic rule over infinite, missing and outlying values."""
    h = summary.histogram(_edge_values(spark, sf), "close", bins="auto")
    return h.select("series_id", "bin", *(F.when(F.abs(F.col(c)) < float("inf"), F.round(F.col(c), 4)).alias(c) for c in ("lo_edge", "hi_edge")), "count", "reason")


@query("kde")
def kde(spark, sf):
    k = summary.kde(B.bars_orders(spark, sf), "close", grid=200)
    return k.select("series_id", "grid_index", r("x", 2), F.round(F.col("density") * 1e6, 6).alias("density_e6"))


# ---- evaluation ------------------------------------------------------------------------------------

def _baseline_metrics(spark, sf):
    fc = baselines.baseline_forecasts(B.bars_orders(spark, sf), 30)
    return evaluate.forecast_metrics(fc)


@query("baseline_forecasts")
def baseline_forecasts(spark, sf):
    fc = baselines.baseline_forecasts(B.bars_orders(spark, sf), 30)
    return fc.select("series_id", "model", "ts", "horizon", "actual", r("forecast", 4))


@query("forecast_metrics")
def forecast_metrics(spark, sf):
    m = _baseline_metrics(spark, sf)
    return m.select("series_id", "model", "n", r("rmse", 4), r("mse", 2), r("mae", 4), r("r2", 8), r("mape", 6),
                    r("mape_pos", 6), r("medae", 4), r("medae_pos", 4), r("msle", 8))


@query("leaderboard")
def leaderboard(spark, sf):
    lb = evaluate.leaderboard(_baseline_metrics(spark, sf))
    return lb.select("series_id", "metric", "model", "rank")


@query("win_share")
def win_share(spark, sf):
    ws = evaluate.win_share(_baseline_metrics(spark, sf))
    return ws.select("series_id", "model", r("win_share", 8), "n_metrics")


@query("best_model")
def best_model(spark, sf):
    bm = evaluate.best_model(_baseline_metrics(spark, sf))
    return bm.select("series_id", "best_model", r("best_rmse", 4))


@query("forecast_union_tail")
def forecast_union_tail(spark, sf):
    """O4 + W14 + X4: forecast tables with different columns unioned by name; models named
    like the exponential-smoothing file keep only their last 30 rows."""
    b = baselines.one_step_baselines(B.bars_orders(spark, sf))
    naive = b.select("series_id", "ts", F.col("close").alias("actual"), F.col("naive").alias("forecast"))
    drift = b.select("series_id", "ts", F.col("close").alias("actual"), F.col("drift").alias("forecast"),
                     (F.col("close") - F.col("drift")).alias("error"))
    ets = b.select("series_id", "ts", F.col("mean5").alias("forecast"), F.col("close").alias("actual"))
    u = evaluate.union_forecasts({"naive": naive, "drift": drift, "exp_smoothing_mean5": ets})
    t = evaluate.tail_per_model(u, 30)
    return t.select("series_id", "model", "ts", "actual", r("forecast", 4), r("error", 4))


@query("hash_split_counts")
def hash_split_counts(spark, sf):
    s = splits.hash_split(B.bars_orders(spark, sf), ["series_id", "ts"])
    return s.groupBy("series_id", "split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# ---- step 5/6: series statistics -------------------------------------------------------------------

def _walk(spark, sf):
    return B.bars_walk(spark, sf)


def _levels_and_walk(spark, sf, differences=False):
    """Level bars, the random walk made of them, and on demand the differenced walk, from one
    aggregation of the raw rows and one running sum."""
    b = materialize(B.bars_orders(spark, sf).select("series_id", "ts", "close"))
    w = materialize(B.walk(b).select("series_id", "ts", "close"))
    named = [("level|", b), ("walk|", w)]
    if differences:
        named.append(("dwalk|", fe.first_difference(w).select("series_id", "ts", F.col("diff").alias("close"))))
    out = None
    for prefix, d in named:
        d = d.select(F.concat(F.lit(prefix), "series_id").alias("series_id"), "ts", "close")
        out = d if out is None else out.unionByName(d)
    return out


@query("acf30")
def acf30(spark, sf):
    a = diagnostics.acf(diagnostics.autocov_sums(_walk(spark, sf), "close", 30), 30)
    return a.select("series_id", "lag", r("acf", 8))


@query("acf_bands")
def acf_bands(spark, sf):
    a = diagnostics.acf_bands(diagnostics.acf(diagnostics.autocov_sums(_walk(spark, sf), "close", 40), 40))
    return a.select("series_id", "lag", r("acf", 8), r("acf_band", 8), r("pacf_band", 8))


@query("ljung_box")
def ljung_box(spark, sf):
    lb = diagnostics.ljung_box(diagnostics.autocov_sums(_levels_and_walk(spark, sf), "close", 10), 10)
    return lb.select("series_id", "n", r("lb_stat", 6), r("lb_pvalue", 8))


@query("kpss")
def kpss(spark, sf):
    k = diagnostics.kpss(_levels_and_walk(spark, sf), "close")
    return k.select("series_id", "n", "kpss_lags", r("kpss_stat", 8), r("kpss_pvalue", 8))


@query("decompose_additive")
def decompose_additive(spark, sf):
    d = diagnostics.decompose(_walk(spark, sf), "close", 30, "additive")
    return d.select("series_id", "ts", r("observed", 6), r("trend", 8), r("seasonal", 8), r("resid", 6), "reason")


@query("decompose_multiplicative")
def decompose_multiplicative(spark, sf):
    d = diagnostics.decompose(_walk(spark, sf), "close", 30, "multiplicative")
    return d.select("series_id", "ts", r("observed", 6), r("trend", 8), r("seasonal", 8), r("resid", 8), "reason")


def _levels_and_differences(spark, sf):
    b = materialize(B.bars_orders(spark, sf))
    lv = b.select(F.concat(F.lit("level|"), "series_id").alias("series_id"), "ts", "close")
    df = fe.first_difference(b).select(F.concat(F.lit("diff|"), "series_id").alias("series_id"), "ts", F.col("diff").alias("close"))
    return lv.unionByName(df)


@query("decompose_auto")
def decompose_auto(spark, sf):
    """T9 -> T8: each series decomposed by its own model, levels (positive) and differences together."""
    d = diagnostics.decompose(_levels_and_differences(spark, sf), "close", 30, "auto")
    return d.select("series_id", "ts", "model", r("observed", 6), r("trend", 6), r("seasonal", 6), r("resid", 6), "reason")


@query("stationarity_edge")
def stationarity_edge(spark, sf):
    """T2 on series without enough to go on: a constant one, the first 30 bars, and the longest
    (hourly events)."""
    b = materialize(B.bars_orders(spark, sf))
    const = b.select(F.concat(F.lit("constant|"), "series_id").alias("series_id"), "ts", F.lit(7.25).alias("close"))
    first = splits.numbered(b).where("pos <= 30").select(F.concat(F.lit("first30|"), "series_id").alias("series_id"), "ts", "close")
    ev = B.bars_events(spark, sf).select(F.concat(F.lit("events|"), "series_id").alias("series_id"), "ts", "close")
    dated = const.unionByName(first).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    k = diagnostics.kpss(dated.unionByName(ev), "close")
    return k.select("series_id", "n", "kpss_lags", r("kpss_stat", 8), r("kpss_pvalue", 8), "kpss_reason")


_LAYOUTS: dict = {}  # (application, input, fixture) -> stored layout


def _stored(spark, sf, which):
    """Bars in the stored positional layout: written by the first query of an application that asks for them."""
    make = {"orders": lambda: B.bars_orders(spark, sf),
            "features": lambda: fe.technical_features(B.bars_orders(spark, sf)).select("series_id", "ts", "sma_5", "sma_20", "rsi_14"),
            "walk": lambda: _walk(spark, sf), "levels_and_walk": lambda: _levels_and_walk(spark, sf)}
    at = (spark.sparkContext.applicationId, sf, which)
    if at not in _LAYOUTS:
        _LAYOUTS[at] = layout.store(make[which]())
    return _LAYOUTS[at]


@query("stored_rolling_mean")
def stored_rolling_mean(spark, sf):
    """W4 on the stored layout: the window starts from the scan."""
    return fe.rolling(_stored(spark, sf, "orders"), windows=(5, 20, 30), std_windows=()).select(
        "series_id", "ts", r("sma_5", 4), r("sma_20", 4), r("sma_30", 4))


@query("stored_backfill")
def stored_backfill(spark, sf):
    """P13 on the stored layout of the features."""
    f = fe.backfill(_stored(spark, sf, "features"), ["sma_5", "sma_20", "rsi_14"])
    return f.select("series_id", "ts", r("sma_5", 4), r("sma_20", 4), r("rsi_14", 8))


@query("stored_acf30")
def stored_acf30(spark, sf):
    """T4 on the stored layout."""
    a = diagnostics.acf(diagnostics.autocov_sums(_stored(spark, sf, "walk"), "close", 30), 30)
    return a.select("series_id", "lag", r("acf", 8))


@query("stored_kpss")
def stored_kpss(spark, sf):
    """T2 on the stored layout: lag sums and running sums from the stored segments."""
    k = diagnostics.kpss(_stored(spark, sf, "levels_and_walk"), "close")
    return k.select("series_id", "n", "kpss_lags", r("kpss_stat", 8), r("kpss_pvalue", 8))


@query("stored_decompose")
def stored_decompose(spark, sf):
    """T8 on the stored layout."""
    d = diagnostics.decompose(_stored(spark, sf, "walk"), "close", 30, "additive")
    return d.select("series_id", "ts", r("observed", 6), r("trend", 8), r("seasonal", 8), r("resid", 6), "reason")


_LIVE: dict = {}


def _live(spark, sf):
    """Statistics of level and walk bars after ten appends, each of a tenth of the time span."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _LIVE:
        bars = materialize(_levels_and_walk(spark, sf))
        span = bars.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
        tenth = F.floor(F.datediff("ts", F.lit(span["a"])) * 10 / ((span["b"] - span["a"]).days + 1))
        state = None
        for i in range(10):
            state = incremental.update(state, bars.where(tenth == i))
        _LIVE[at] = state
    return _LIVE[at]


@query("live_ljung_box")
def live_ljung_box(spark, sf):
    """T3 from sums kept up to date from new bars only."""
    lb = diagnostics.ljung_box(incremental.autocov_sums(_live(spark, sf)), 10)
    return lb.select("series_id", "n", r("lb_stat", 6), r("lb_pvalue", 8))


@query("live_kpss")
def live_kpss(spark, sf):
    """T2 from sums kept up to date from new bars only."""
    k = incremental.kpss(_live(spark, sf))
    return k.select("series_id", "n", "kpss_lags", r("kpss_stat", 8), r("kpss_pvalue", 8))


@query("live_describe")
def live_describe(spark, sf):
    """A4 from sums and value counts kept up to date from new bars only (the level bars)."""
    d = incremental.describe(_live(spark, sf)).where("series_id LIKE 'level|%'").withColumn("series_id", F.substring("series_id", 7, 100))
    return d.select("series_id", "count", r("mean", 4), r("std", 3), r("min", 4), r("p25", 4), r("p50", 4), r("p75", 4), r("max", 4))


@query("decompose_type")
def decompose_type(spark, sf):
    return diagnostics.decompose_type(_levels_and_differences(spark, sf), "close")


@query("residual_anomalies")
def residual_anomalies(spark, sf):
    d = diagnostics.decompose(B.bars_orders(spark, sf), "close", 30, "additive")
    a = diagnostics.residual_anomalies(d, 2.0)
    return a.select("series_id", "ts", "observed", r("resid", 4), r("z_score", 6))


@query("adf")
def adf(spark, sf):
    """T1 on level bars, the random-walk bars and the differenced walk."""
    a = regression.adf(_levels_and_walk(spark, sf, differences=True), "close")
    return a.select("series_id", "n", r("adf_stat", 6), r("adf_pvalue", 6), "used_lag", "nobs")


@query("pacf30")
def pacf30(spark, sf):
    py = diagnostics.pacf_yw(diagnostics.autocov_sums(_walk(spark, sf), "close", 30), 30, 4)
    return diagnostics.pacf_long(py).select("series_id", "lag", r("pacf", 8))


@query("yule_walker4")
def yule_walker4(spark, sf):
    dw = fe.first_difference(_walk(spark, sf)).select("series_id", "ts", F.col("diff").alias("close"))
    py = diagnostics.pacf_yw(diagnostics.autocov_sums(dw, "close", 4), 4, 4)
    return py.select("series_id", "n", F.transform("ar_coef", lambda x: F.round(x, 8)).alias("ar_coef"),
                     r("sigma2", 8), r("sigma", 8))


def _series_tests(df):
    df = materialize(df)
    sums = materialize(diagnostics.autocov_sums(df, "close", 40))
    a = regression.adf(df, "close")
    lb = diagnostics.ljung_box(sums, 10).select("series_id", "lb_pvalue")
    k = diagnostics.kpss(df, "close", sums=sums).select("series_id", "kpss_stat", "kpss_pvalue")
    sd = summary.std_pop(df, "close")
    return a.join(lb, "series_id").join(k, "series_id").join(sd, "series_id")


@query("stationarity_verdict")
def stationarity_verdict(spark, sf):
    """T11 on levels, the walk and the differenced walk (the level and the differenced-series flows)."""
    t = _series_tests(_levels_and_walk(spark, sf, differences=True))
    return t.select("series_id", r("adf_pvalue", 6), r("kpss_pvalue", 6),
                    diagnostics.stationarity_verdict("adf_pvalue", "kpss_pvalue").alias("verdict"))


@query("white_noise_gate")
def white_noise_gate(spark, sf):
    """T10 + A2: series of at least 50 rows, minus likely white noise (ADF p > .05, Ljung-Box
    p > .05 and population std < 1), on differenced series as in the differenced-series flow."""
    many = B.bars_many(spark, sf).select("series_id", "ts", "close")
    d = clean.length_gate(fe.first_difference(many).select("series_id", "ts", F.col("diff").alias("close")), 50)
    t = _series_tests(d)
    noise = (F.col("adf_pvalue") > 0.05) & (F.col("lb_pvalue") > 0.05) & (F.col("std_pop") < 1.0)
    return t.select("series_id", r("adf_pvalue", 6), r("lb_pvalue", 6), r("std_pop", 4), (~F.coalesce(noise, F.lit(False))).alias("kept"))


# ---- step 7: forecasters -------------------------------------------------------------------------

def _holdout(spark, sf, models):
    fc = forecasting.holdout_forecasts(_walk_ohlcv(spark, sf), 30, models)
    return fc.select("series_id", "model", "ts", "horizon", "actual", r("forecast", 4))


def _walk_ohlcv(spark, sf):
    """Random-walk closes and opens with the orders bars' volume (for the VAR); the bars are made
    once."""
    b = materialize(B.bars_orders(spark, sf))
    w = B.walk(b, "close", "close")
    o = B.walk(b, "open", "open").select("series_id", "ts", "open")
    return w.drop("open").join(o, ["series_id", "ts"])


@query("holt_forecast")
def holt_forecast(spark, sf):
    return _holdout(spark, sf, ("holt",))


@query("arima_forecast")
def arima_forecast(spark, sf):
    """ARIMA(4,0,1) by conditional least squares profiled over theta."""
    return _holdout(spark, sf, ("arima",))


@query("arima_hr_forecast")
def arima_hr_forecast(spark, sf):
    """F1 by Hannan-Rissanen two-stage least squares (no sequential filter at all)."""
    return _holdout(spark, sf, ("arima_hr",))


@query("var_forecast")
def var_forecast(spark, sf):
    return _holdout(spark, sf, ("var",))


@query("garch_variance")
def garch_variance(spark, sf):
    train, _ = forecasting.split_holdout(B.bars_orders(spark, sf), 30)
    g = smoothing.garch_forecast(smoothing.garch_fit(train, "close"), 30)
    return g.select("series_id", "horizon", r("variance", 2), r("volatility", 4))


@query("model_comparison")
def model_comparison(spark, sf):
    """Forecasters with a closed form and the two baselines on one common ordered holdout."""
    fc = forecasting.holdout_forecasts(_walk_ohlcv(spark, sf), 30, ("naive", "drift", "holt", "arima_hr", "var"))
    m = evaluate.forecast_metrics(fc.withColumn("forecast", F.round("forecast", 4)))
    return m.select("series_id", "model", "n", r("rmse", 4), r("mae", 4), r("r2", 6), r("mape", 6), r("medae", 4))


@query("model_comparison_all")
def model_comparison_all(spark, sf):
    """Every forecaster, the recursive linear and network ones included, on the same holdout."""
    m = evaluate.forecast_metrics(forecasting.holdout_forecasts(_walk_ohlcv(spark, sf), 30))
    return m.select("series_id", "model", "n", r("rmse", 4), r("mae", 4), r("r2", 6), r("mape", 6), r("medae", 4))


# ---- step 8/9: machine-learning forecasters ---------------------------------------------------------

_MADE: dict = {}  # (application, input, name) -> a result that several queries read


def _once(spark, sf, name, make):
    """A result written by the first query of an application that asks for it."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _MADE:
        _MADE[at] = materialize(make())
    return _MADE[at]


def _forecast_rows(fc):
    """The part of a forecast table that does not depend on the model's arithmetic."""
    return fc.select("series_id", "model", "ts", r("actual", 4), F.col("forecast").isNotNull().alias("has_forecast"))


def _ml_metrics(fc):
    m = evaluate.forecast_metrics(fc, key=("model",))
    return m.select("model", "n", r("rmse", 4), r("mae", 4), r("r2", 6), r("mape", 6), r("mape_pos", 6),
                    r("medae", 4), r("msle", 8))


def _tree_query(spark, sf, kind):
    """F5/F6 as in the reference (same-day features, 80/20 hash split, pooled over series)
    and leak-free (previous-day features, same split)."""
    bars = materialize(B.bars_many(spark, sf).withColumn("volume", F.col("volume").cast("double")))

    def one(mode):
        d, cols = ml.same_day_features(bars) if mode == "same_day" else ml.lagged_features(bars)
        d = materialize(splits.hash_split(d, ["series_id", "ts"]))  # feeds both the fit and the scoring
        model = ml.fit_pipeline(d.filter("split = 'train'"), cols, "close", kind)
        return ml.to_forecasts(model.transform(d.filter("split = 'test'")), f"{kind}_{mode}", "close")
    with ThreadPoolExecutor(2) as ex:  # a fit is hundreds of short jobs, one after the other; the two fits fill each other's gaps
        same_day, lagged = ex.map(one, ("same_day", "lagged"))
    return same_day.unionByName(lagged)


@query("random_forest")
def random_forest(spark, sf):
    return _ml_metrics(_once(spark, sf, "rf", lambda: _tree_query(spark, sf, "rf")))


@query("random_forest_rows")
def random_forest_rows(spark, sf):
    """Which rows the forest forecasts, with their labels."""
    return _forecast_rows(_once(spark, sf, "rf", lambda: _tree_query(spark, sf, "rf")))


@query("gbt")
def gbt(spark, sf):
    return _ml_metrics(_once(spark, sf, "gbt", lambda: _tree_query(spark, sf, "gbt")))


@query("gbt_rows")
def gbt_rows(spark, sf):
    """which rows the boosted trees forecast, with their labels."""
    return _forecast_rows(_once(spark, sf, "gbt", lambda: _tree_query(spark, sf, "gbt")))


@query("lagged_feature_rows")
def lagged_feature_rows(spark, sf):
    """M12 + M1 + P4: the assembled feature vector of each bar with five earlier ones, and its split."""
    d, cols = ml.lagged_features(B.bars_many(spark, sf).withColumn("volume", F.col("volume").cast("double")))
    v = ml.assembler(cols).transform(splits.hash_split(d, ["series_id", "ts"]))
    return v.select("series_id", "ts", "split", F.transform(vector_to_array("features"), lambda x: F.round(x, 4)).alias("features"), r("close", 4))


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """K4: a forest saved, loaded again and applied to the test rows; both forecasts agree on each."""
    d, cols = ml.lagged_features(B.bars_orders(spark, sf))
    d = materialize(splits.hash_split(d, ["series_id", "ts"]))
    model = ml.fit_pipeline(d.where("split = 'train'"), cols, "close", "rf", numTrees=3)
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/roundtrip-{uuid.uuid4().hex}"
    ml.save_model(model, path)
    test = d.where("split = 'test'")
    again = PipelineModel.load(path).transform(test).select("series_id", "ts", F.col("prediction").alias("again"))
    return model.transform(test).join(again, ["series_id", "ts"]).select(
        "series_id", "ts", r("close", 4), (F.col("prediction") == F.col("again")).alias("same"))


def _windows(spark, sf, **kw):
    return materialize(ml.window_dataset(B.bars_orders(spark, sf), "close", 20, **kw))


@query("windowed_regression")
def windowed_regression(spark, sf):
    """F9/F10 re-aimed: 20-lag windows, per-series scaling fitted on training rows, last 20 %
    of each series as test; linear and forest estimators against last value."""
    ds = _windows(spark, sf)
    lin = ml.windowed_regression(ds, "linear")
    rf = ml.windowed_regression(ds, "rf")
    last = ds.filter("split = 'test'").select(
        "series_id", F.lit("last_value").alias("model"), "ts", F.lit(None).cast("int").alias("horizon"), "actual",
        (vector_to_array("features")[19] * (F.col("vmax") - F.col("vmin")) + F.col("vmin")).alias("forecast"))
    return _ml_metrics(lin.unionByName(rf).unionByName(last))


@query("random_search")
def random_search(spark, sf):
    """M3/M4: 10 sampled GBT configurations scored on the ordered validation tail."""
    t = ml.random_search(_windows(spark, sf), "gbt", trials=10)
    return t.select("trial", "params", r("valid_rmse", 6), "best")


@query("mlp")
def mlp(spark, sf):
    """Data-parallel dense network on 20-lag windows, last 25 windows of each series as
    test (as the dense-network script): 50 epochs, two hidden layers, dropout, early stopping."""
    return _ml_metrics(_mlp(spark, sf))


def _mlp(spark, sf):
    def make():
        ds = _windows(spark, sf, test_windows=25)
        return neural.mlp_forecasts(neural.train_mlp(ds, hidden=(64, 32), epochs=50, lr=3e-3, batch=32, dropout=0.1), ds)
    return _once(spark, sf, "mlp", make)


@query("mlp_rows")
def mlp_rows(spark, sf):
    """Which windows the network forecasts, with their labels."""
    return _forecast_rows(_mlp(spark, sf))


@query("network_search")
def network_search(spark, sf):
    """M3/M4 over the network: 10 random networks by validation loss; the configurations tried."""
    ds = _windows(spark, sf, test_windows=25)
    trials, _ = neural.search_networks(ds, trials=10, epochs=50)
    return trials.select("trial", "hidden", r("dropout", 1), r("lr", 6), r("valid_loss", 6), "best")


@query("multivariate_windows")
def multivariate_windows(spark, sf):
    """W9 + F10: forecasts of the last 25 windows of five features, 20 rows each."""
    ds = materialize(ml.multivariate_dataset(B.bars_orders(spark, sf)))
    return _ml_metrics(ml.multivariate_forecasts(ds, "rf"))


@query("multivariate_window_rows")
def multivariate_window_rows(spark, sf):
    """Windows, split and label of each row, with the oldest and newest lag of each feature."""
    ds = ml.multivariate_dataset(B.bars_orders(spark, sf))
    return ds.select("series_id", "ts", "split", r("target", 4), *[r(f"{x}_{j}", 4) for x in ml.WINDOW_FEATURES for j in (0, 19)])


@query("permutation_importance")
def permutation_importance(spark, sf):
    """M8 on a forest fitted to 20-row windows of five features (close, SMA 5/20, EMA 10, up
    ratio), each feature's 20 lags permuted together across windows."""
    wide = materialize(ml.multivariate_dataset(B.bars_orders(spark, sf)))
    cols = [c for c in wide.columns if c not in ("series_id", "ts", "split", "target")]
    model = ml.fit_pipeline(wide.filter("split = 'train'"), cols, "target", "rf")
    imp = ml.permutation_importance(model, wide.filter("split = 'test'"), {x: [f"{x}_{j}" for j in range(20)] for x in ml.WINDOW_FEATURES},
                                    label="target", order=["series_id", "ts"])
    return imp.select("feature", r("mse_increase_pct", 4))


@query("permuted_rows")
def permuted_rows(spark, sf):
    """M8's permutation of all bars (by series and date), keyed by 42: each bar with the close it takes."""
    b = materialize(ranks.row_numbers(B.bars_orders(spark, sf).select("series_id", "ts", "close"), ["series_id", "ts"]))
    taken = b.select("series_id", "ts", "_row", ranks.permuted_row("_row", b.count(), 42).alias("source_row"))
    return taken.join(b.select(F.col("_row").alias("source_row"), F.round("close", 4).alias("close")), "source_row") \
        .select("series_id", "ts", F.col("_row").alias("row"), "source_row", "close")


def _boosted(spark, sf, **kw):
    """Second-order boosting on lagged features (hash split as F5/F6): the scored test rows."""
    bars = materialize(B.bars_many(spark, sf).withColumn("volume", F.col("volume").cast("double")))
    d, cols = ml.lagged_features(bars)
    d = materialize(splits.hash_split(d, ["series_id", "ts"]))
    model = boosting.fit(d.where("split = 'train'"), cols, "close", **kw)
    return model.predict(d.where("split = 'test'"))


@query("boosting")
def boosted_trees(spark, sf):
    """F6 with second-order splits: three trees of depth two, each test row's forecast."""
    p = _boosted(spark, sf, rounds=3, depth=2, eta=0.3, bins=32)
    return p.select("series_id", "ts", r("close", 4), r("prediction", 4))


@query("boosting_100")
def boosted_trees_100(spark, sf):
    """F6 as the reference sets it: 100 rounds, depth 5, step 0.1."""
    return _ml_metrics(ml.to_forecasts(_boosted(spark, sf), "boosting_100", "close"))


# ---- step 10: streaming ------------------------------------------------------------------------

@query("stream_bars")
def stream_bars(spark, sf):
    """The streamed hourly bars equal the batch bars."""
    return live.run_live_bars(spark, sf, "events.parquet")


@query("stream_lag_windows")
def stream_lag_windows(spark, sf):
    """R2 state: 20-value lag windows per event type, from files in shuffled order."""
    return scoring.replay(spark.read.parquet(f"{sf}/events.parquet"), 20).select("series_id", "ts", "lags", "target")


def _scored(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_type").alias("series_id"), "ts", F.col("value").alias("close"))
    seq = splits.holdout_fraction(fe.lag_sequences(ev, "close", 20), 0.8).withColumn("features", ml.array_to_vector("lags"))
    seq = materialize(seq)
    train, test = seq.filter("split = 'train'"), seq.filter("split = 'test'")
    models = {"linear": ml.regressor("linear", label="target").fit(train),
              "rf": ml.regressor("rf", label="target").fit(train)}
    fc = None
    for name, mdl in models.items():
        f = ml.to_forecasts(mdl.transform(test), name, "target")
        fc = f if fc is None else fc.unionByName(f)
    chosen = evaluate.best_model(evaluate.forecast_metrics(fc.withColumn("series_id", F.lit("all")))).first()["best_model"]
    s = scoring.replay(spark.read.parquet(f"{sf}/events.parquet"), 20, models[chosen])
    return s.select("series_id", "ts", "target", "prediction", F.lit(chosen).alias("model"))


@query("stream_scoring")
def stream_scoring(spark, sf):
    """R2 + M11: candidate lag-window models (linear, forest) are fitted on the batch windows of
    the same events, the one with the lowest RMSE on the ordered batch holdout is chosen, and
    that stateless model scores the windows the stream builds from per-series state."""
    s = _once(spark, sf, "stream_scoring", lambda: _scored(spark, sf))
    return s.select("series_id", "ts", "target", r("prediction", 6), "model")


@query("stream_scoring_rows")
def stream_scoring_rows(spark, sf):
    """R2: which rows the stream scores, with their targets."""
    s = _once(spark, sf, "stream_scoring", lambda: _scored(spark, sf))
    return s.select("series_id", "ts", "target", F.col("prediction").isNotNull().alias("scored"))


# ---- sources and sinks -----------------------------------------------------------------------------

def _scratch(spark, name):
    from tsforge.streaming.common import stream_paths
    return stream_paths(spark, None, name)[1]


@query("csv_roundtrip")
def csv_roundtrip(spark, sf):
    """K2 -> S1/S2: bars exported as CSV per series folder and read back with a declared schema."""
    path = _scratch(spark, "bars_csv")
    b = B.bars_orders(spark, sf).withColumnRenamed("series_id", "ticker")
    sinks.write_csv(b.select("ticker", F.date_format("ts", "yyyy-MM-dd").alias("Date"), "open", "high", "low", "close", "volume"),
                    path, ["ticker"])
    schema = "Date string, open double, high double, low double, close double, volume bigint, ticker string"
    back = files.read_csv(spark, path, T.StructType.fromDDL(schema), date_col="Date")
    return back.select(F.col("ticker").alias("series_id"), F.col("Date").alias("ts"), "open", "high", "low", "close", "volume")


@query("forecast_files")
def forecast_files(spark, sf):
    """K1/K2 -> S3 + O4 + W14: one forecast CSV per model (columns differ between models), read
    back in one scan with the model taken from the file name; the exponential-smoothing-like
    file keeps its last 30 rows per series."""
    b = baselines.one_step_baselines(B.bars_orders(spark, sf)).filter(F.col("mean5").isNotNull())
    base = _scratch(spark, "forecast_files")
    outs = {
        "naive_forecast": b.select("series_id", F.date_format("ts", "yyyy-MM-dd").alias("Date"),
                                   F.col("close").alias("Actual"), F.col("naive").alias("Forecast")),
        "exp_smoothing_forecast": b.select("series_id", F.date_format("ts", "yyyy-MM-dd").alias("Date"),
                                           F.col("mean5").alias("Forecast"), F.col("close").alias("Actual")),
        "drift_forecast": b.select("series_id", F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.col("close").alias("Actual"),
                                   F.col("drift").alias("Forecast"), (F.col("close") - F.col("drift")).alias("Error")),
    }
    for name, d in outs.items():
        sinks.write_csv(d, f"{base}/{name}.csv")
    schema = T.StructType.fromDDL("series_id string, Date date, Actual double, Forecast double")
    fc = files.read_forecast_files(spark, [f"{base}/{n}.csv" for n in outs], schema)
    fc = fc.withColumn("ts", F.col("Date")).withColumnRenamed("Actual", "actual").withColumnRenamed("Forecast", "forecast")
    t = evaluate.tail_per_model(fc, 30)
    return t.select("series_id", "model", "ts", F.col("actual").cast("double").alias("actual"),
                    F.round(F.col("forecast").cast("double"), 4).alias("forecast"))


@query("parquet_partitions")
def parquet_partitions(spark, sf):
    """K3: forecast table written partitioned by model, read back with a partition filter
    (only the chosen model's folder is scanned)."""
    path = _scratch(spark, "forecasts_parquet")
    fc = baselines.baseline_forecasts(B.bars_orders(spark, sf), 30)
    sinks.write_parquet(fc, path, ["model"])
    back = spark.read.parquet(path).filter(F.col("model") == "naive")
    return back.select("series_id", "model", "ts", "horizon", "actual", F.round("forecast", 4).alias("forecast"))


@query("sql_view")
def sql_view(spark, sf):
    """K5 + O3: forecast table as a temp view, first 5 rows by date through SQL."""
    fc = baselines.baseline_forecasts(B.bars_orders(spark, sf), 30)
    sinks.register_view(fc.withColumn("error", F.col("actual") - F.col("forecast")), "baseline_results")
    return spark.sql("""select series_id, model, ts, actual, round(forecast, 4) as forecast, round(error, 4) as error
                        from baseline_results order by ts, series_id, model limit 5""")


@query("metrics_table")
def metrics_table(spark, sf):
    """The metrics table in the dashboard's wide layout (one column per metric) written
    and read back, per series and model."""
    m = _baseline_metrics(spark, sf)
    wide = m.select("series_id", F.col("model").alias("model_name"), r("rmse", 4), r("mse", 2), r("mae", 4), r("mape", 6),
                    r("r2", 8), r("medae", 4), r("msle", 8))
    path = _scratch(spark, "metrics_table")
    sinks.write_parquet(wide, path)
    return files.read_metrics_table(spark, path)


@query("holt_grid")
def holt_grid(spark, sf):
    """F2 grid: root mean squared one-step error of Holt's method on the 0.05 (alpha, beta) grid,
    started from the first value with no trend, for each random-walk series."""
    g = smoothing.holt_sse_grid(_walk(spark, sf), "close")
    return g.select("series_id", r("alpha", 2), r("beta", 2), F.round(F.sqrt(F.col("sse") / F.col("n")), 6).alias("rmse"))


@query("future_forecast")
def future_forecast(spark, sf):
    """Holt and ARIMA forecasts for the 30 calendar days after each walk series ends."""
    f = forecasting.future_forecasts(_walk(spark, sf), 30)
    return f.select("series_id", "model", "ts", "horizon", r("forecast", 4))


@query("histogram_auto")
def histogram_auto(spark, sf):
    """A5 with seaborn's default bin rule (numpy 'auto': narrower of Sturges and Freedman-Diaconis)."""
    h = summary.histogram(B.bars_orders(spark, sf), "close", bins="auto")
    return h.select("series_id", "bin", r("lo_edge", 4), r("hi_edge", 4), "count")


@query("recursive_ml_forecast")
def recursive_ml_forecast(spark, sf):
    """Lag-window linear regression and the data-parallel network forecasting the same 30-step
    holdout as the classical models, each prediction fed back as the newest lag."""
    return _holdout(spark, sf, ("linear_rec", "mlp_rec"))


@query("multistep_baselines")
def multistep_baselines(spark, sf):
    """J1 + yardsticks: last value and drift carried 30 steps from the end of training, aligned
    with the held-out actuals by (series, horizon)."""
    return _holdout(spark, sf, ("naive", "drift"))


@query("pacf40_mle")
def pacf40_mle(spark, sf):
    """T5 as drawn by the dashboard: 40 lags, Yule-Walker on autocovariances with divisor n."""
    py = diagnostics.pacf_yw(diagnostics.autocov_sums(_walk(spark, sf), "close", 40), 40, 4, method="mle")
    return diagnostics.pacf_long(py).select("series_id", "lag", r("pacf", 8))


@query("extract_series_csv")
def extract_series_csv(spark, sf):
    """P1 + P2 + P6 + K1: one entity's bars written as a single CSV file (one series, so one
    writer task is fine) and read back with a declared schema."""
    path = _scratch(spark, "extract_csv")
    one = clean.extract_series(B.bars_orders(spark, sf), "1-URGENT", drop=("volume",))
    sinks.write_single_csv(one.select(F.date_format("ts", "yyyy-MM-dd").alias("Date"), "open", "high", "low", "close",
                                      F.col("series_id").alias("Ticker")), path)
    schema = T.StructType.fromDDL("Date string, open double, high double, low double, close double, Ticker string")
    back = files.read_csv(spark, path, schema, date_col="Date")
    return back.select(F.col("Ticker").alias("series_id"), F.col("Date").alias("ts"), "open", "high", "low", "close")


@query("distinct_series")
def distinct_series(spark, sf):
    """A1: the entities present (25 priority|segment series)."""
    return clean.distinct_series(B.bars_many(spark, sf))


@query("std_pop")
def std_pop(spark, sf):
    """A3: population standard deviation of each series' differenced closes."""
    d = fe.first_difference(B.bars_many(spark, sf))
    return summary.std_pop(d, "diff").select("series_id", r("std_pop", 4))


@query("forecast_selection")
def forecast_selection(spark, sf):
    """P11 + P12: the forecasts of the selected models only, with error and absolute error."""
    fc = clean.keep_values(baselines.baseline_forecasts(B.bars_orders(spark, sf), 30), "model", ["naive", "mean5"])
    e = clean.with_errors(fc)
    return e.select("series_id", "model", "ts", "actual", r("forecast", 4), r("error", 4), r("abs_error", 4))
