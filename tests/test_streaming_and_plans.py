import os
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF001
from tsforge.operators import features as fe
from tsforge.session import checkpoint_dir
from tsforge.sources import bars as B
from tsforge.streaming import bars as live, scoring


def _folder(spark):
    d = os.path.join(checkpoint_dir(spark), "stream-input", uuid.uuid4().hex)
    os.makedirs(d)
    return d


def _events(rows):
    return pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])


def _write(folder, name, pdf):
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    pdf.to_parquet(os.path.join(folder, name), index=False, coerce_timestamps="us", allow_truncated_timestamps=True)
    t = os.path.getmtime(os.path.join(folder, name))
    return t


def test_late_rows_are_dropped_by_the_watermark(spark):
    """Three micro-batches: history to 10:00, an on-time tick, then a tick 8 hours behind the
    watermark. Spark filters late rows with the watermark of the previous batch, so the third
    batch's late tick must not reach its (already emitted) bar."""
    folder = _folder(spark)
    base = pd.Timestamp("2024-01-01")
    files = [
        _events([(i, base + pd.Timedelta(minutes=30 * i), 1, "a", float(i), "") for i in range(21)]),  # to 10:00
        _events([(101, base + pd.Timedelta(hours=10, minutes=20), 1, "a", 5.0, "")]),                 # on time
        _events([(100, base + pd.Timedelta(hours=2, minutes=5), 1, "a", 999.0, "")]),                  # late
    ]
    for i, f in enumerate(files):
        t = _write(folder, f"part-{i}.parquet", f)
        os.utime(os.path.join(folder, f"part-{i}.parquet"), (t - 100 + 10 * i, t - 100 + 10 * i))
    ticks = live.tick_stream(spark, folder, "*.parquet", files_per_trigger=1)
    out = os.path.join(folder, "_out")
    q = (live.live_bars(ticks, late="2 hours").select("series_id", F.col("w.start").cast("timestamp_ntz").alias("ts"), "high", "volume")
             .writeStream.outputMode("append").option("checkpointLocation", os.path.join(folder, "_ckpt"))
             .foreachBatch(lambda b, e: b.write.mode("append").parquet(out)).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out).toPandas()
    h2 = got[got.ts == base + pd.Timedelta(hours=2)]
    assert len(h2) == 1 and h2.high.iloc[0] == 5.0 and h2.volume.iloc[0] == 2   # emitted once, late tick absent
    assert (got.high < 999).all()
    assert got.ts.max() < base + pd.Timedelta(hours=9)                            # open windows held back


def _ticks(spark, pdf):
    pdf = pdf.copy()
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    return spark.createDataFrame(pdf[["event_id", "ts", "event_type", "value"]], "event_id long, ts timestamp_ntz, event_type string, value double")


def _check_windows(got, pdf, lookback=20):
    for s, g in pdf.groupby("event_type"):
        vals = g.sort_values(["ts", "event_id"]).value.to_numpy()
        mine = got[got.series_id == s].sort_values("ts", kind="stable")
        assert len(mine) == max(0, len(vals) - lookback), s
        want = sorted(map(tuple, (np.r_[vals[i:i + lookback], vals[i + lookback]] for i in range(len(vals) - lookback))))
        assert np.allclose(sorted(map(tuple, (np.r_[a, t] for a, t in zip(mine.lags, mine.target)))), want) if want else True


def test_lag_windows_of_shuffled_slices(spark):
    base = pd.Timestamp("2024-01-01")
    rng = np.random.default_rng(3)
    rows = [(i, base + pd.Timedelta(minutes=7 * i), 1, s, float(rng.normal()), "") for i in range(120) for s in ("a", "b")]
    pdf = _events([(k, *r[1:]) for k, r in enumerate(rows)])
    _check_windows(scoring.replay(_ticks(spark, pdf)).toPandas(), pdf)


def test_lag_windows_of_a_burst_and_of_ties(spark):
    base = pd.Timestamp("2024-01-01")
    burst = [(i, base + pd.Timedelta(microseconds=250 * i), 1, "burst", float(i), "") for i in range(100)]
    ties = [(500 + i, base, 1, "ties", float(i), "") for i in range(40)]
    pdf = _events(burst + ties)
    _check_windows(scoring.replay(_ticks(spark, pdf)).toPandas(), pdf)


def test_one_series_waits_by_spans_and_sparse_spans_are_linked(spark):
    """A hot series is dealt over tasks by its spans; a span with fewer values than a window needs
    takes them from many earlier ones, over micro-batches too; a quiet time forgets only if asked."""
    folder, base = _folder(spark), pd.Timestamp("2024-01-01")
    spans = scoring.closed_spans(live.tick_stream(spark, folder))
    plan = spans._jdf.queryExecution().analyzed().toString()
    assert "Aggregate [series_id" in plan and "window" in plan and "TransformWithState" not in plan
    rng = np.random.default_rng(5)
    at = [0, *np.cumsum(rng.integers(20, 400, 89)).tolist()]  # minutes: some spans have rows, most have none or one
    rows = [(i, base + pd.Timedelta(minutes=m), 1, "hot", float(rng.normal()), "") for i, m in enumerate(at)]
    later = [(100 + i, base + pd.Timedelta(days=60, minutes=7 * i), 1, "hot", float(rng.normal()), "") for i in range(30)]
    pdf = _events(rows + later)
    _check_windows(scoring.replay(_ticks(spark, pdf)).toPandas(), pdf)
    got = scoring.replay(_ticks(spark, pdf), idle_hours=24 * 20).toPandas()
    assert len(got) == 70 + 10 and got[got.ts >= base + pd.Timedelta(days=60)].ts.min() == base + pd.Timedelta(days=60, minutes=140)


def test_late_row_within_the_bound_is_used_and_restart_resumes(spark):
    folder, base = _folder(spark), pd.Timestamp("2024-01-01")
    rows = [(i, base + pd.Timedelta(minutes=10 * i), 1, "a", float(i), "") for i in range(60)]
    late = rows.pop(40)  # arrives one file later, 90 minutes behind
    files = [_events(rows[:49]), _events([late, *rows[49:]]), _events([(None, base + pd.Timedelta(days=30), 1, "a", None, "")])]
    name = f"restart-{uuid.uuid4().hex}"
    for i, f in enumerate(files):  # one run for each file: each run goes on from the checkpoint
        f["event_id"] = f["event_id"].astype("Int64")
        t = _write(folder, f"part-{i}.parquet", f)
        os.utime(os.path.join(folder, f"part-{i}.parquet"), (t - 100 + 10 * i, t - 100 + 10 * i))
        got = scoring.run_lag_windows(spark, folder, "*.parquet", 20, name=name).toPandas()
    pdf = _events([*rows, late])
    _check_windows(got, pdf)


def test_a_retried_epoch_leaves_its_rows_once(spark):
    from tsforge.streaming.common import epoch_sink
    out = os.path.join(_folder(spark), "table")
    sink = epoch_sink(out)
    for epoch, n in ((0, 5), (1, 7), (1, 7)):
        sink(spark.range(n), epoch)
    assert spark.read.parquet(out).count() == 12


def test_results_do_not_depend_on_partitioning(spark):
    b = B.bars_orders(spark, SF001)
    cols = ["series_id", "ts", "sma_20", "roll_std_30", "ema_10", "rsi_14"]
    r = lambda d: d.select(*[F.round(c, 8).alias(c) if c not in ("series_id", "ts") else c for c in cols])
    a = r(fe.technical_features(b))
    c = r(fe.technical_features(b.repartition(7)))
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_feature_windows_are_partitioned_by_series_and_segment(spark):
    b = B.bars_orders(spark, SF001)
    plan = fe.technical_features(b)._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert windows and all("_seg" in ln for ln in windows if "lag(" in ln or "avg(" in ln)
    assert "hashpartitioning(series_id" in plan and "_seg" in plan
