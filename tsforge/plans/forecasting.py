"""All forecasters on one common ordered holdout: fit on every row but the last ``h`` of each
series, forecast ``h`` steps, align with the held-out actuals by (series, horizon)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.ml.functions import array_to_vector, vector_to_array

from tsforge.operators import arma, evaluate, ml, neural, smoothing, splits
from tsforge.session import materialize

MODELS = ("naive", "drift", "holt", "arima", "var", "linear_rec", "mlp_rec")


def split_holdout(bars: DataFrame, h: int = 30):
    t = splits.holdout_tail(bars, h)
    train = t.filter(~F.col("is_test")).drop("is_test", "horizon")
    test = t.filter("is_test").select("series_id", "ts", "horizon", F.col("close").alias("actual"))
    return train, test


def multi_step_baselines(train: DataFrame, h: int = 30) -> DataFrame:
    """Last value and drift (last + h * mean difference) carried over the horizon."""
    st = train.groupBy("series_id").agg(F.max_by("close", "ts").alias("_last"), F.min_by("close", "ts").alias("_first"),
                                        F.count(F.lit(1)).alias("_n"))
    hz = F.explode(F.sequence(F.lit(1), F.lit(h))).alias("horizon")
    b = st.select("series_id", "_last", "_first", "_n", hz)
    slope = F.try_divide(F.col("_last") - F.col("_first"), F.col("_n") - 1)
    return b.select("series_id", F.col("horizon").cast("int"),
                    F.col("_last").alias("naive"), (F.col("_last") + F.col("horizon") * slope).alias("drift"))


def _numpy_recursion(state: DataFrame, predict_np, h: int, lookback: int) -> DataFrame:
    """Run the ``h``-step recursion for every series in one pass over the one-row-per-series
    state table, with a small model evaluated in numpy (``predict_np``: windows -> next values)."""
    import numpy as np
    import pandas as pd

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            lags = np.stack(pdf["lags"].to_numpy()).astype(float)
            lo, hi = pdf["vmin"].to_numpy(dtype=float), pdf["vmax"].to_numpy(dtype=float)
            out = []
            for k in range(1, h + 1):
                y = predict_np(lags)
                out.append(pd.DataFrame({"series_id": pdf["series_id"].to_numpy(), "horizon": k,
                                         "forecast": y * (hi - lo) + lo}))
                lags = np.concatenate([lags[:, 1:], y[:, None]], axis=1)
            yield pd.concat(out, ignore_index=True)
    return state.mapInPandas(run, "series_id string, horizon int, forecast double")


def recursive_forecasts(train: DataFrame, h: int = 30, kind: str = "linear", lookback: int = 20, **params) -> DataFrame:
    """Multi-step forecasts from a lag-window regression: the model is fitted on every training
    window (per-series min-max scaling from the training rows), then each step's prediction is
    appended to the window that predicts the next step. The recursion only touches a
    one-row-per-series state table: small models (linear, the dense network) run all ``h``
    steps in one ``mapInPandas`` pass with their broadcast parameters; other Spark ML models
    step through ``h`` transforms of the state table.

    ``kind`` is a Spark ML regressor ('linear', 'rf', 'gbt') or 'mlp' (data-parallel network)."""
    import numpy as np
    sc = train.sparkSession.sparkContext
    valid = 0.1 if kind == "mlp" else 0.0
    ds = ml.window_dataset(train, "close", lookback, train_frac=1.0, valid_frac=valid)
    arr = vector_to_array("features")
    state = materialize(ds.groupBy("series_id").agg(
        F.max_by(F.slice(F.concat(arr, F.array("label")), 2, lookback), "ts").alias("lags"),
        F.first("vmin").alias("vmin"), F.first("vmax").alias("vmax")))
    if kind == "mlp":
        res = neural.train_mlp(ds, hidden=params.get("hidden", (32,)), epochs=params.get("epochs", 50),
                               lr=params.get("lr", 3e-3), batch=params.get("batch", 32))
        bw = sc.broadcast(res.weights)
        return _numpy_recursion(state, lambda x: neural.forward(bw.value, x)[0], h, lookback)
    model = ml.regressor(kind, label="label", **params).fit(ds)
    if kind == "linear":
        coef = sc.broadcast((np.asarray(model.coefficients.toArray()), float(model.intercept)))
        return _numpy_recursion(state, lambda x: x @ coef.value[0] + coef.value[1], h, lookback)
    outs = []
    for k in range(1, h + 1):
        pred = materialize(model.transform(state.withColumn("features", array_to_vector("lags"))).drop("features"))
        outs.append(pred.select("series_id", F.lit(k).alias("horizon"),
                                (F.col("prediction") * (F.col("vmax") - F.col("vmin")) + F.col("vmin")).alias("forecast")))
        state = pred.select("series_id", "vmin", "vmax", F.slice(F.concat("lags", F.array("prediction")), 2, lookback).alias("lags"))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def holdout_forecasts(bars: DataFrame, h: int = 30, models=MODELS, var_cols=("close", "open", "volume")) -> DataFrame:
    """Long forecast table ``series_id, model, ts, horizon, actual, forecast``."""
    train, test = split_holdout(bars, h)
    train = materialize(train)
    parts = []
    if "naive" in models or "drift" in models:
        b = multi_step_baselines(train, h)
        for m in ("naive", "drift"):
            if m in models:
                parts.append(b.select("series_id", "horizon", F.lit(m).alias("model"), F.col(m).alias("forecast")))
    if "holt" in models:
        parts.append(smoothing.holt_forecast(smoothing.holt_fit(train, "close"), h).withColumn("model", F.lit("holt")))
    if "arima" in models:
        parts.append(arma.arima_css(train, "close", 4, h).select("series_id", "horizon", "forecast").withColumn("model", F.lit("arima")))
    if "arima_hr" in models:
        parts.append(arma.arima_hr(train, "close", 4, h).select("series_id", "horizon", "forecast").withColumn("model", F.lit("arima_hr")))
    if "var" in models:
        missing = [c for c in var_cols if c not in bars.columns]
        if missing:
            raise ValueError(f"the VAR needs columns {missing}; pass var_cols or leave it out of models")
        v = arma.var_forecast(train, list(var_cols), 5, h).filter(F.col("variable") == var_cols[0])
        parts.append(v.select("series_id", "horizon", "forecast").withColumn("model", F.lit("var")))
    for m in ("linear_rec", "rf_rec", "mlp_rec"):
        if m in models:
            kind = m.split("_")[0]
            parts.append(recursive_forecasts(train, h, kind).withColumn("model", F.lit(m)))
    fc = parts[0].select("series_id", "model", "horizon", "forecast")
    for p in parts[1:]:
        fc = fc.unionByName(p.select("series_id", "model", "horizon", "forecast"))
    return evaluate.align(fc, test).select("series_id", "model", "ts", "horizon", "actual", "forecast")


def future_forecasts(bars: DataFrame, h: int = 30, models=("holt", "arima")) -> DataFrame:
    """fit on every row and forecast ``h`` steps past the end of each series; step k is
    dated last date + k calendar days (the anchor is the last observed date)."""
    last = bars.groupBy("series_id").agg(F.max("ts").alias("_last"))
    parts = []
    if "holt" in models:
        parts.append(smoothing.holt_forecast(smoothing.holt_fit(bars, "close"), h).withColumn("model", F.lit("holt")))
    if "arima" in models:
        parts.append(arma.arima_css(bars, "close", 4, h).select("series_id", "horizon", "forecast").withColumn("model", F.lit("arima")))
    fc = parts[0].select("series_id", "model", "horizon", "forecast")
    for p in parts[1:]:
        fc = fc.unionByName(p.select("series_id", "model", "horizon", "forecast"))
    return (fc.join(last, "series_id")
              .select("series_id", "model", F.date_add("_last", F.col("horizon")).alias("ts"), "horizon", "forecast"))
