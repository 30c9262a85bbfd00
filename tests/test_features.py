import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tsforge.operators import features as fe, segments as sg, splits
from tsforge.sources import bars as B

COLS = ["series_id", "ts", "log_return", "sma_5", "sma_20", "roll_mean_30", "roll_std_30", "ema_10", "rsi_14"]


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if c not in ("series_id", "ts") else F.col(c) for c in COLS])


def test_segmented_layout_equals_whole_series(spark):
    b = B.bars_orders(spark, SF01)  # ~1,700 rows per series: two segments of 1,000 plus halo
    seg = _rounded(fe.technical_features(b, size=1000, unit="week"))  # halo 920 rows (EMA blocks) across segments
    whole = _rounded(fe.technical_features(b, layout="series"))
    assert seg.count() == whole.count() == b.count()
    assert seg.exceptAll(whole).count() == 0


def test_features_match_pandas(spark):
    b = B.bars_orders(spark, SF01)
    f = fe.technical_features(b, size=1000).toPandas()
    for sid, g in f.groupby("series_id"):
        g = g.sort_values("ts")
        c = g.close
        assert np.allclose(g.sma_5, c.rolling(5).mean(), equal_nan=True)
        assert np.allclose(g.roll_std_30, c.rolling(30).std(), equal_nan=True)
        assert np.allclose(g.ema_10, c.ewm(span=10, adjust=False).mean(), rtol=1e-13, atol=0)
        d = c.diff()
        rsi = d.apply(lambda x: max(x, 0)).rolling(14).mean() / d.abs().rolling(14).mean()
        assert np.allclose(g.rsi_14, rsi, equal_nan=True)


def test_positions_and_running_sum(spark):
    b = B.bars_orders(spark, SF001)
    p = sg.with_positions(b, unit="week")
    rs = sg.running_sum(p, "volume", "cum", size=37).toPandas()
    for sid, g in rs.groupby("series_id"):
        g = g.sort_values("ts")
        assert list(g[sg.POS]) == list(range(1, len(g) + 1))
        assert np.allclose(g.cum, g.volume.cumsum())


def test_lag_sequences_and_backfill(spark):
    b = B.bars_orders(spark, SF001)
    n = b.groupBy("series_id").count().toPandas().set_index("series_id")["count"]
    s = fe.lag_sequences(b, lookback=20, size=64).toPandas()
    assert (s.groupby("series_id").size().sort_index() == (n - 20).sort_index()).all()
    row = s.sort_values(["series_id", "ts"]).iloc[0]
    closes = b.filter(F.col("series_id") == row.series_id).orderBy("ts").toPandas().close.to_numpy()
    assert np.allclose(row.lags, closes[:20]) and row.target == closes[20]
    f = fe.technical_features(b).select("series_id", "ts", "sma_20")
    bf = fe.backfill(f, ["sma_20"], size=7, unit="week").toPandas()
    ref = f.toPandas().sort_values(["series_id", "ts"])
    ref["sma_20"] = ref.groupby("series_id").sma_20.bfill()
    m = bf.merge(ref, on=["series_id", "ts"])
    assert np.allclose(m.sma_20_x, m.sma_20_y)


def test_splits(spark):
    b = B.bars_orders(spark, SF001)
    t = splits.holdout_tail(b, 30).toPandas()
    assert (t.groupby("series_id").is_test.sum() == 30).all()
    f = splits.holdout_fraction(b, 0.8, 0.1).toPandas()
    for sid, g in f.groupby("series_id"):
        n = len(g)
        g = g.sort_values("ts")
        assert (g.split.iloc[: int(np.floor(n * 0.8))] != "test").all()
        assert (g.split == "test").sum() == n - int(np.floor(n * 0.8))
    h1 = splits.hash_split(b, ["series_id", "ts"]).groupBy("split").count().collect()
    h2 = splits.hash_split(b.repartition(7), ["series_id", "ts"]).groupBy("split").count().collect()
    assert sorted(h1) == sorted(h2)


def test_exact_quantiles_with_refinement(spark):
    from tsforge.operators.summary import exact_quantiles
    rng = np.random.default_rng(4)
    vals = {"a": rng.standard_normal(20000), "b": rng.integers(0, 50, 5000).astype(float), "c": np.array([3.0])}
    rows = [(k, float(v)) for k, arr in vals.items() for v in arr]
    df = spark.createDataFrame(rows, "series_id string, v double")
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for max_rows in (1000, 10**9):  # with and without bracket refinement rounds
        got = {(r[0], r[1]): r[2] for r in exact_quantiles(df, "v", qs, rank_values=max_rows, cells=100).collect()}
        for k, arr in vals.items():
            for q in qs:
                assert got[(k, q)] == pytest.approx(np.quantile(arr, q), rel=1e-12, abs=1e-12), (k, q, max_rows)


def test_histogram_auto_bins_match_numpy(spark):
    from tsforge.operators.summary import histogram
    b = B.bars_orders(spark, SF001)
    pdf = b.select("series_id", "close").toPandas()
    for rule in ("auto", "fd", "sturges"):
        h = histogram(b, "close", bins=rule).toPandas()
        for sid, g in pdf.groupby("series_id"):
            edges = np.histogram_bin_edges(g.close.to_numpy(), bins=rule)
            counts, _ = np.histogram(g.close.to_numpy(), bins=edges)
            mine = h[h.series_id == sid].sort_values("bin")
            full = np.zeros(len(counts), dtype=int)
            full[mine.bin.to_numpy()] = mine["count"].to_numpy()
            assert len(counts) == int(mine.bin.max()) + 1, (rule, sid)  # the last bin holds the maximum
            assert (full == counts).all(), (rule, sid)


def test_ema_block_scan_equals_fold(spark):
    b = B.bars_orders(spark, SF01)
    scan = fe.ema_feature(b, span=10, size=1000)
    fold = fe.windowed(b, [{"fold": fe.ema_fold("close", 10)}], before=199, size=1000)
    m = scan.join(fold.select("series_id", "ts", "fold"), ["series_id", "ts"]).toPandas()
    assert len(m) == b.count()
    assert np.allclose(m.ema_10, m.fold, rtol=1e-12, atol=0)
