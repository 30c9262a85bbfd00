"""Spark ML plumbing and tree / linear forecasters.

Models are pooled over all series (one distributed fit), features come from the window
layer, and every prediction lands in the common forecast table.
"""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import features as fe
from tsforge.operators import ranks
from tsforge.operators import segments as sg
from tsforge.session import materialize, reuse_input


# ---- feature sets (M12) ----------------------------------------------------------------------------

def same_day_features(bars: DataFrame, label: str = "close", exclude=("series_id", "ts")) -> tuple[DataFrame, list[str]]:
    """The reference's feature set: every other numeric column of the same bar (leaks the
    label's day; kept for comparison)."""
    from tsforge.operators.clean import feature_columns
    cols = feature_columns(bars, [label, *exclude])
    return bars, cols


def lagged_features(bars: DataFrame, label: str = "close", lags: int = 5, **kw) -> tuple[DataFrame, list[str]]:
    """Leak-free feature set: the previous bar's OHLCV and the last ``lags`` closes."""
    others = [c for c in ("open", "high", "low", "volume") if c in bars.columns]
    steps = {f"prev_{c}": (lambda c: lambda w: F.lag(c, 1).over(w))(c) for c in others}
    steps.update({f"{label}_lag{i}": (lambda i: lambda w: F.lag(label, i).over(w))(i) for i in range(1, lags + 1)})
    d = fe.windowed(bars, [steps], before=lags, **kw)
    cols = list(steps)
    return d.dropna(subset=cols), cols


# ---- estimators (F5, F6, F9/F10) ----------------------------------------------------------------------

def regressor(kind: str, label: str = "label", features: str = "features", seed: int = 42, **params):
    if kind == "rf":
        return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=params.pop("numTrees", 100),
                                     seed=seed, **params)
    if kind == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=params.pop("maxIter", 100),
                            maxDepth=params.pop("maxDepth", 5), stepSize=params.pop("stepSize", 0.1), seed=seed, **params)
    if kind == "linear":
        return LinearRegression(featuresCol=features, labelCol=label, **params)
    raise ValueError(kind)


def assembler(cols: list[str], out: str = "features") -> VectorAssembler:
    """M1 (rows with null or NaN features are skipped, as the reference's dropna did)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip")


def fit_pipeline(train: DataFrame, cols: list[str], label: str, kind: str, **params) -> PipelineModel:
    """Assemble + regress; ``label`` is copied to ``label`` column name expected by the model."""
    est = regressor(kind, label=label, **params)
    return Pipeline(stages=[assembler(cols), est]).fit(train)


def to_forecasts(pred: DataFrame, model: str, label: str, key="series_id", ts="ts") -> DataFrame:
    """prediction column -> forecast table rows."""
    return pred.select(key, F.lit(model).alias("model"), ts, F.lit(None).cast("int").alias("horizon"),
                       F.col(label).cast("double").alias("actual"), F.col("prediction").alias("forecast"))


def save_model(model: PipelineModel, path: str) -> None:
    """K4."""
    model.write().overwrite().save(path)


# ---- lag-window regression (F9 / F10) ---------------------------------------------------------------

def window_dataset(bars: DataFrame, value: str = "close", lookback: int = 20, test_windows: int | None = None,
                   train_frac: float = 0.8, valid_frac: float = 0.1, **kw) -> DataFrame:
    """Scaled lag windows with ordered splits: per-series min-max scaling fitted on the bars
    before the first test window (W15), ``features`` vector of the ``lookback`` previous scaled values (W8/W10),
    ``label`` the scaled value, ``split`` train/valid/test (last ``test_windows`` windows or
    the fraction split)."""
    from tsforge.operators import splits
    seq = fe.lag_sequences(bars, value, lookback, **kw)
    if test_windows:
        t = splits.holdout_tail(seq, test_windows)
        t = t.withColumn("split", F.when(F.col("is_test"), "test").otherwise("train")).drop("is_test", "horizon")
        t = splits.holdout_fraction(t.filter("split = 'train'").drop("split"), 1.0, valid_frac).unionByName(
            t.filter("split = 'test'"))
    else:
        t = splits.holdout_fraction(seq, train_frac, valid_frac)
    # fitted on the bars before the first test window, the first windows' own values included
    start = t.filter("split = 'test'").groupBy("series_id").agg(F.min("ts").alias("_start"))
    known = bars.select("series_id", "ts", value).join(start, "series_id", "left")
    p = fe.minmax_params(known.filter(F.col("_start").isNull() | (F.col("ts") < F.col("_start"))), value)
    sc = t.join(sg._maybe_broadcast(p), "series_id")
    rng = F.col("vmax") - F.col("vmin")
    scaled = F.transform("lags", lambda x: F.try_divide(x - F.col("vmin"), rng))
    return sc.select("series_id", "ts", "split", "vmin", "vmax",
                     array_to_vector(scaled).alias("features"),
                     F.try_divide(F.col("target") - F.col("vmin"), rng).alias("label"),
                     F.col("target").alias("actual")).dropna(subset=["label"])


def windowed_regression(ds: DataFrame, kind: str = "linear", name: str | None = None, **params) -> DataFrame:
    """F9/F10 re-aimed: next-value regression on lag windows with a pluggable estimator, fitted
    on train + valid rows, scored on test rows, predictions mapped back to price units."""
    est = regressor(kind, label="label", **params)
    model = est.fit(ds.filter("split != 'test'"))
    pred = model.transform(ds.filter("split = 'test'"))
    f = F.col("prediction") * (F.col("vmax") - F.col("vmin")) + F.col("vmin")
    return pred.select("series_id", F.lit(name or kind).alias("model"), "ts", F.lit(None).cast("int").alias("horizon"),
                       "actual", f.alias("forecast"))


# ---- windows of several features (W9, F10) ---------------------------------------------------------------

WINDOW_FEATURES = ["close", "sma_5", "sma_20", "ema_10", "rsi_14"]


def multivariate_dataset(bars: DataFrame, lookback: int = 20, test_windows: int = 25, features: list[str] | None = None) -> DataFrame:
    """W9 + W10: the ``lookback`` earlier rows of each feature (technical features, gaps filled
    backwards) as columns ``feature_j``, the row's close as ``target``, and the last
    ``test_windows`` windows of each series as ``split`` = test."""
    from tsforge.operators import splits
    names = features or WINDOW_FEATURES
    f = fe.backfill(fe.technical_features(bars).select("series_id", "ts", *names), names)
    wide = fe.widen(fe.multivariate_sequences(f, names, "close", lookback), "lags", n=lookback, fields=names)
    t = splits.holdout_tail(wide, test_windows)
    cols = [f"{x}_{j}" for x in names for j in range(lookback)]
    return t.select("series_id", "ts", F.when(F.col("is_test"), "test").otherwise("train").alias("split"), "target", *cols)


def multivariate_forecasts(ds: DataFrame, kind: str = "rf", name: str | None = None, **params) -> DataFrame:
    """F10 re-aimed: next close from the windows of all features, fitted on the train windows and
    forecast for the test windows."""
    cols = [c for c in ds.columns if c not in ("series_id", "ts", "split", "target")]
    model = fit_pipeline(ds.filter("split = 'train'"), cols, "target", kind, **params)
    return to_forecasts(model.transform(ds.filter("split = 'test'")), name or f"{kind}_multivariate", "target")


# ---- model selection (M3-M5) ------------------------------------------------------------------------

GBT_SPACE = {"maxDepth": [2, 3, 4, 5, 6], "stepSize": (0.01, 0.3), "maxIter": [25, 50, 75, 100], "subsamplingRate": [0.6, 0.8, 1.0]}


def sample_params(est, space: dict, n: int, seed: int = 42) -> list:
    """M3: ``n`` random ParamMaps; tuples are log-uniform ranges, lists are choices."""
    rng = random.Random(seed)
    maps = []
    for _ in range(n):
        pm = {}
        for name, dom in space.items():
            p = est.getParam(name)
            if isinstance(dom, tuple):
                lo, hi = dom
                pm[p] = float(lo * (hi / lo) ** rng.random())
            else:
                pm[p] = rng.choice(dom)
        maps.append(pm)
    return maps


def random_search(ds: DataFrame, kind: str = "gbt", space: dict | None = None, trials: int = 10, seed: int = 42,
                  parallelism: int = 4) -> DataFrame:
    """M3 + M4: fit ``trials`` sampled configurations on the training rows (``fitMultiple`` in
    threads) and score each on the ordered validation tail. One row per trial with the
    parameters, validation RMSE and a ``best`` flag (top-1 by validation RMSE)."""
    spark = ds.sparkSession
    est = regressor(kind, label="label")
    maps = sample_params(est, space or GBT_SPACE, trials, seed)
    ds = reuse_input(ds)
    train, valid = ds.filter("split = 'train'"), ds.filter("split = 'valid'")
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")

    def run(i):
        m = est.fit(train, maps[i])
        return i, ev.evaluate(m.transform(valid))

    with ThreadPoolExecutor(parallelism) as ex:
        scores = dict(ex.map(run, range(trials)))
    rows = [(i, {p.name: str(v) for p, v in maps[i].items()}, float(scores[i])) for i in range(trials)]
    t = spark.createDataFrame(rows, "trial int, params map<string,string>, valid_rmse double")
    best = min(scores, key=lambda i: (scores[i], i))
    return t.withColumn("best", F.col("trial") == best)


def gbt_early_stopping(ds: DataFrame, tol: float = 0.01, **params):
    """M5 for trees: GBT stops adding trees when the validation error stops improving
    (rows with ``split = 'valid'`` are the validation set)."""
    d = ds.filter("split != 'test'").withColumn("is_valid", F.col("split") == "valid")
    est = regressor("gbt", label="label", validationIndicatorCol="is_valid", validationTol=tol, **params)
    return est.fit(d)


# ---- permutation importance (M8) -------------------------------------------------------------------

def permutation_importance(model, ds: DataFrame, groups: dict[str, list[str]], label: str = "label",
                           seed: int = 42, order: list[str] | None = None) -> DataFrame:
    """M8: for each feature group, permute its columns together across all rows, re-score and report
    the percentage rise in MSE over the unpermuted score, sorted descending.

    A row takes the group's values of the row that a keyed bijection of row numbers (``ranks.permute``,
    one key for each group) sends it to, so every permutation is one over the whole table, nothing is
    ranked, and all groups and the unpermuted score are one job: rows times groups, joined with the
    rows by number. ``order`` numbers the rows by these columns (by their place in the input if not
    given)."""
    spark = ds.sparkSession
    names = list(groups)
    rows = ranks.row_numbers(ds, order) if order else ranks.numbered(ds)
    rows = materialize(rows)
    n = rows.count()
    cols = sorted({c for g in groups.values() for c in g})
    each = rows.withColumn("_group", F.explode(F.sequence(F.lit(-1), F.lit(len(names) - 1))))
    source = F.when(F.col("_group") < 0, F.col("_row")).otherwise(ranks.permuted_row("_row", n, "_key"))
    each = each.withColumn("_key", (F.lit(seed) + 17 * F.col("_group")).cast("long")).withColumn("_from", source)
    other = rows.select(F.col("_row").alias("_from"), F.struct(*[F.col(c) for c in cols]).alias("_other"))
    mixed = each.join(other, "_from").withColumns({
        c: F.when(F.col("_group").isin([i for i, g in enumerate(names) if c in groups[g]]), F.col(f"_other.{c}")).otherwise(F.col(c)) for c in cols})
    scored = model.transform(mixed.drop("_other", "_from", "_key", "_row"))
    err = F.pow(F.col(label) - F.col("prediction"), 2)
    mse = {r["_group"]: r["mse"] for r in scored.groupBy("_group").agg(F.avg(err).alias("mse")).collect()}  # a row for each group
    base = mse.get(-1)
    out = [(name, float((mse[i] - base) / base * 100.0) if base else None) for i, name in enumerate(names)]
    return spark.createDataFrame(out, "feature string, mse_increase_pct double").orderBy(F.desc("mse_increase_pct"))
