import os
import threading

from pyspark.ml import PipelineModel

from conftest import SF001
from tsforge.operators import ml, neural, splits
from tsforge.session import checkpoint_dir
from tsforge.sources import bars as B


def test_network_loss_falls_and_scores(spark):
    ds = ml.window_dataset(B.walk(B.bars_orders(spark, SF001)), "close", 20, test_windows=25).cache()
    res = neural.train_mlp(ds, hidden=(16,), epochs=6, lr=3e-3, batch=16, partitions=2, patience=10)
    tr = [h for h in res.history if h[1] == "train"]
    assert tr[-1][2] < tr[0][2]
    assert [h[0] for h in res.history if h[1] == "valid"] == list(range(1, 7))
    hist = res.history_df(spark)
    assert set(r["split"] for r in hist.collect()) == {"train", "valid"}
    fc = neural.mlp_forecasts(res, ds)
    assert fc.count() == 25 * 5 and fc.filter("forecast is null").count() == 0


def test_pipeline_save_and_early_stopping(spark):
    bars = B.bars_orders(spark, SF001)
    d, cols = ml.lagged_features(bars)
    d = splits.hash_split(d, ["series_id", "ts"])
    model = ml.fit_pipeline(d.filter("split = 'train'"), cols, "close", "rf", numTrees=5)
    path = os.path.join(checkpoint_dir(spark), "models", "rf_test")
    ml.save_model(model, path)
    again = PipelineModel.load(path)
    a = model.transform(d.filter("split = 'test'")).select("prediction").collect()
    b = again.transform(d.filter("split = 'test'")).select("prediction").collect()
    assert a == b
    ds = ml.window_dataset(bars, "close", 20)
    gbt = ml.gbt_early_stopping(ds, tol=0.5, maxIter=50, maxDepth=2)
    assert gbt.getNumTrees < 50


def test_permutation_importance_ranks_informative_feature_first(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    n = 3000
    x1, x2 = rng.standard_normal(n), rng.standard_normal(n)
    rows = [(float(a), float(b), float(3 * a + 0.1 * rng.standard_normal())) for a, b in zip(x1, x2)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, y double")
    model = ml.fit_pipeline(df, ["x1", "x2"], "y", "linear")
    imp = {r["feature"]: r["mse_increase_pct"] for r in
           ml.permutation_importance(model, df, {"x1": ["x1"], "x2": ["x2"]}, label="y").collect()}
    assert imp["x1"] > 1000 and abs(imp["x2"]) < 5


def test_recursive_forecast_paths_agree(spark):
    """The one-pass numpy recursion of a linear model equals stepping Spark ML transforms."""
    from pyspark.sql import functions as F
    from tsforge.plans import forecasting
    train, _ = forecasting.split_holdout(B.walk(B.bars_orders(spark, SF001)), 30)
    fast = forecasting.recursive_forecasts(train, 5, "linear")
    ds = ml.window_dataset(train, "close", 20, train_frac=1.0, valid_frac=0.0)
    model = ml.regressor("linear", label="label").fit(ds)
    from pyspark.ml.functions import array_to_vector, vector_to_array
    state = ds.groupBy("series_id").agg(F.max_by(F.slice(F.concat(vector_to_array("features"), F.array("label")), 2, 20), "ts").alias("lags"),
                                        F.first("vmin").alias("vmin"), F.first("vmax").alias("vmax"))
    out = {}
    for k in range(1, 6):
        pred = model.transform(state.withColumn("features", array_to_vector("lags"))).drop("features").cache()
        for r in pred.collect():
            out[(r["series_id"], k)] = r["prediction"] * (r["vmax"] - r["vmin"]) + r["vmin"]
        state = pred.select("series_id", "vmin", "vmax", F.slice(F.concat("lags", F.array("prediction")), 2, 20).alias("lags"))
    got = fast.collect()
    assert len(got) == len(out)
    for r in got:
        assert abs(r["forecast"] - out[(r["series_id"], r["horizon"])]) < 1e-6


def test_gradient_with_dropout_matches_differences():
    import numpy as np
    rng = np.random.default_rng(5)
    ws = [w + 0.05 for w in neural.init_weights(4, (6, 5), 3)]  # no unit exactly at its kink
    x, y = rng.standard_normal((20, 4)), rng.standard_normal(20)

    def loss(w):
        pred, _ = neural.forward(w, x, 0.5, np.random.default_rng(9))
        return float(((pred - y) ** 2).mean())
    g, _, _ = neural._grads(ws, x, y, 0.5, np.random.default_rng(9))
    for k in range(len(ws)):
        for at in np.ndindex(ws[k].shape):
            up, down = [w.copy() for w in ws], [w.copy() for w in ws]
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - g[k][at]) < 1e-5


def test_network_search_refits_the_best(spark):
    ds = ml.window_dataset(B.walk(B.bars_orders(spark, SF001)), "close", 20, test_windows=25).cache()
    space = {"units_input": [8, 16], "dropout": [0.1], "num_layers": [1, 2], "units": [8], "lr": (1e-3, 1e-2)}
    trials, res = neural.search_networks(ds, trials=3, epochs=2, space=space, partitions=2)
    rows = trials.collect()
    assert len(rows) == 3 and sum(r["best"] for r in rows) == 1
    best = min(rows, key=lambda r: (r["valid_loss"], r["trial"]))
    assert best["best"] and [w.shape[1] for w in res.weights[:-2:2]] == best["hidden"]


def test_multivariate_forecasts_cover_the_last_windows(spark):
    ds = ml.multivariate_dataset(B.bars_orders(spark, SF001))
    fc = ml.multivariate_forecasts(ds.cache(), "linear")
    assert fc.count() == 25 * 5 and fc.where("forecast IS NULL").count() == 0


def test_the_two_tree_fits_of_a_query_run_side_by_side(spark, monkeypatch):
    from tsforge.plans import catalog
    both, fit = threading.Barrier(2, timeout=120), ml.fit_pipeline

    def waits(train, cols, label, kind, **params):
        both.wait()  # breaks if one fit has to end before the other begins
        return fit(train, cols, label, kind, maxIter=2, **params)
    monkeypatch.setattr(ml, "fit_pipeline", waits)
    got = catalog._tree_query(spark, SF001, "gbt")
    n = {r["model"]: r["count"] for r in got.groupBy("model").count().collect()}
    assert set(n) == {"gbt_same_day", "gbt_lagged"} and n["gbt_same_day"] > n["gbt_lagged"] > 0
    assert got.where("forecast IS NULL").count() == 0
