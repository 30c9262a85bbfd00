import numpy as np
from pyspark.sql import functions as F
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from conftest import SF001
from tsforge.operators import evaluate
from tsforge.streaming import bars as live


def test_metrics_edge_cases_and_evaluator(spark):
    rows = [("s", "m", 1, a, f) for a, f in [(10.0, 12.0), (0.0, 1.0), (-5.0, -4.0), (8.0, 7.5), (3.0, -1.0)]]
    fc = spark.createDataFrame(rows, "series_id string, model string, horizon int, actual double, forecast double")
    m = evaluate.forecast_metrics(fc).collect()[0]
    a = np.array([r[3] for r in rows])
    f = np.array([r[4] for r in rows])
    e = a - f
    assert m["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert m["r2"] == pytest.approx(1 - (e ** 2).sum() / ((a - a.mean()) ** 2).sum())
    nz = a != 0
    assert m["mape"] == pytest.approx(100 * np.abs(e[nz] / a[nz]).mean())
    pos = (a > 0) & (f > 0)
    assert m["mape_pos"] == pytest.approx(100 * np.abs(e[pos] / a[pos]).mean())
    assert m["msle"] == pytest.approx(((np.log1p(a[pos]) - np.log1p(f[pos])) ** 2).mean())
    assert m["medae"] == pytest.approx(np.median(np.abs(e)))
    ev = RegressionEvaluator(labelCol="actual", predictionCol="forecast")
    for k in ("rmse", "mae", "r2"):
        assert m[k] == pytest.approx(ev.setMetricName(k).evaluate(fc))
    none_pos = spark.createDataFrame([("s", "m", 1, -1.0, 2.0)], fc.schema)
    assert evaluate.forecast_metrics(none_pos).collect()[0]["msle"] is None


def test_win_share_counts_ties_half(spark):
    rows = [("s", "a", 1.0, 0.9), ("s", "b", 1.0, 0.8), ("s", "c", 2.0, 0.95)]
    m = spark.createDataFrame(rows, "series_id string, model string, rmse double, r2 double")
    ws = {r["model"]: r["win_share"] for r in evaluate.win_share(m, names=("rmse", "r2")).collect()}
    # rmse: a,b tie (1.5 wins each of 2), c loses both; r2: c > a > b
    assert ws == pytest.approx({"a": (1.5 + 1) / 4, "b": (1.5 + 0) / 4, "c": (0 + 2) / 4})


def test_stream_append_emits_closed_windows_only(spark):
    batch = {(r[0], r[1]): tuple(r[2:]) for r in live.run_live_bars(spark, SF001, "events.parquet", "complete").collect()}
    app = live.run_live_bars(spark, SF001, "events.parquet", "append").collect()
    assert 0 < len(app) < len(batch)
    for r in app:
        assert batch[(r[0], r[1])] == tuple(r[2:])
    last = max(k[1] for k in batch)
    assert all(r[1] < last for r in app)


def test_filters_and_formatting(spark):
    from tsforge.operators import clean
    df = spark.createDataFrame([("a", 1234.56789, 12.345), ("b", 0.5, None)], "model string, rmse double, mape double")
    assert [r["model"] for r in clean.keep_values(df, "model", ["b"]).collect()] == ["b"]
    out = {r["model"]: r for r in evaluate.format_metrics(df).collect()}
    assert out["a"]["rmse_text"] == "1,234.5679" and out["a"]["mape_text"] == "12.35%"
    assert out["b"]["mape_text"] is None


def test_zoned_dates_to_naive_utc(spark):
    from tsforge.operators import clean
    df = spark.createDataFrame([("2020-01-02 00:30:00-05:00",), ("bad",)], "Date string")
    got = clean.to_naive_utc(df.filter("Date != 'bad'")).collect()[0]["Date"]
    import datetime
    assert got == datetime.datetime(2020, 1, 2, 5, 30)
    d = clean.parse_dates(df, "Date").collect()
    assert d[0]["Date"] == datetime.date(2020, 1, 2) and d[1]["Date"] is None


def test_single_file_export_and_ljung_box_reason(spark):
    import glob
    import os
    from tsforge.operators import diagnostics
    from tsforge.session import checkpoint_dir
    from tsforge.sources import sinks
    df = spark.createDataFrame([("s", i, float(i % 3)) for i in range(40)] + [("c", i, 1.0) for i in range(40)],
                               "series_id string, ts int, close double")
    path = os.path.join(checkpoint_dir(spark), "exports", "single")
    sinks.write_single_csv(df.repartition(4), path)
    assert len(glob.glob(os.path.join(path, "part-*.csv"))) == 1
    d = df.withColumn("ts", F.date_add(F.lit("2020-01-01").cast("date"), F.col("ts")))
    lb = {r["series_id"]: r for r in diagnostics.ljung_box(diagnostics.autocov_sums(d, "close", 10), 10).collect()}
    assert lb["c"]["lb_pvalue"] is None and lb["c"]["lb_reason"] == "constant series"
    assert lb["s"]["lb_reason"] is None and lb["s"]["lb_pvalue"] is not None


def test_csv_sources_infer_and_declared_schema(spark):
    import os
    import uuid
    from pyspark.sql import types as T
    from tsforge.session import checkpoint_dir
    from tsforge.sources import files, sinks
    base = os.path.join(checkpoint_dir(spark), "csv-src", uuid.uuid4().hex)
    a = spark.createDataFrame([("2020-01-02", 1.0, 2.0), ("2020-01-03", 3.0, 2.5)], "Date string, Actual double, Forecast double")
    b = spark.createDataFrame([("2020-01-02", 2.0, 1.0, 1.0)], "Date string, Forecast double, Actual double, Error double")
    sinks.write_csv(a, f"{base}/arima_forecast.csv")
    sinks.write_csv(b, f"{base}/xgboost_predictions.csv")
    inferred = files.read_csv(spark, f"{base}/arima_forecast.csv", schema=None, date_col="Date")
    assert dict(inferred.dtypes) == {"Date": "date", "Actual": "double", "Forecast": "double"}
    # the files order their columns differently; names decide
    schema = T.StructType.fromDDL("Date date, Actual double, Forecast double, Error double")
    both = files.read_forecast_files(spark, [f"{base}/arima_forecast.csv", f"{base}/xgboost_predictions.csv"], schema)
    got = {(r["model"], r["Actual"], r["Forecast"], r["Error"]) for r in both.collect()}
    assert got == {("arima_forecast", 1.0, 2.0, None), ("arima_forecast", 3.0, 2.5, None), ("xgboost_predictions", 1.0, 2.0, 1.0)}
    first = files.preview(both.select("model", "Actual"), ["Actual", "model"], 2).collect()
    assert [r["model"] for r in first] == ["arima_forecast", "xgboost_predictions"]


def test_path_stem_handles_both_separators(spark):
    from tsforge.functions.columns import path_stem
    df = spark.createDataFrame([("C:\\\\out\\\\arima_forecast.csv",), ("/data/out/lstm_forecast.csv",), ("plain",)], "p string")
    assert [r[0] for r in df.select(path_stem("p")).collect()] == ["arima_forecast", "lstm_forecast", "plain"]


def test_medae_positive_pairs(spark):
    rows = [("s", "m", 1, a, f) for a, f in [(10.0, 12.0), (0.0, 1.0), (-5.0, -4.0), (8.0, 7.5), (3.0, -1.0)]]
    fc = spark.createDataFrame(rows, "series_id string, model string, horizon int, actual double, forecast double")
    m = evaluate.forecast_metrics(fc).collect()[0]
    assert m["medae_pos"] == pytest.approx(np.median([2.0, 0.5]))


def test_duplicates_are_resolved_by_the_tie_break(spark):
    from tsforge.operators import clean
    df = spark.createDataFrame([("s", 1, 10, 1.0), ("s", 1, 12, 2.0), ("s", 1, 11, 3.0), ("s", 2, 1, 4.0)], "series_id string, ts int, eid int, v double")
    got = sorted(tuple(r) for r in clean.dedupe(df, "eid").collect())
    assert got == [("s", 1, 12, 2.0), ("s", 2, 1, 4.0)]


def test_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from tsforge import session
    assert session.is_local("local[4]") and session.is_local("local") and not session.is_local("local-cluster[2,1,1024]")
    assert not session.is_local("spark://host:7077") and not session.is_local("yarn")

    class Conf:
        def get(self, key, default=None):
            return None

    class Options:
        def isDefined(self):
            return False

    class Scala:
        def getCheckpointDir(self):
            return Options()

    class Java:
        def sc(self):
            return Scala()

    class Context:
        master, _jsc = "spark://host:7077", Java()

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
