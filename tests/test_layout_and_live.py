"""Stored layout, statistics kept up to date, boosting, global permutations, summaries of odd values."""

import math
import re
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tsforge.operators import boosting, diagnostics, features as fe, incremental, layout, ml, ranks, segments as sg, summary
from tsforge.session import checkpoint_dir
from tsforge.sources import bars as B


def frame(spark, series, start="2020-01-01"):
    rows = [(s, t.date(), None if v is None else float(v)) for s, vs in series.items() for t, v in zip(pd.date_range(start, periods=len(vs)), vs)]
    return spark.createDataFrame(rows, "series_id string, ts date, close double")


@pytest.fixture(scope="module")
def walks(spark):
    rng = np.random.default_rng(0)
    return {"a": 100 + np.cumsum(rng.standard_normal(1_300)), "b": 50 + rng.standard_normal(700), "c": np.full(90, 3.5), "d": rng.random(7)}


# ---- stored layout -------------------------------------------------------------------------------------

def shuffles_before_window(df):
    """Whether any window's input passes through a hash exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    for k, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            depth = len(line) - len(line.lstrip(" :+-|*()0123456789"))
            for below in lines[k + 1:]:
                if len(below) - len(below.lstrip(" :+-|*()0123456789")) <= depth:
                    break
                if re.search(r"(?<!Broadcast)Exchange hashpartitioning", below):
                    return True
    return False


def test_stored_layout_gives_the_same_without_an_exchange(spark, walks):
    df = frame(spark, walks)
    kept = layout.store(df, size=300, before=64, after=32)
    assert kept.where("_home").count() == df.count() and sg.stored(kept)["size"] == 300
    for make in (lambda d, **k: fe.rolling(d, windows=(5, 20, 30), std_windows=(30,), **k),
                 lambda d, **k: fe.first_difference(d, **k),
                 lambda d, **k: diagnostics.decompose(d, "close", 30, "additive", **k).drop("model")):
        got, want = make(kept), make(df, size=300)
        assert not shuffles_before_window(got) and shuffles_before_window(want)
        a, b = (x.select("series_id", "ts", *sorted(c for c in x.columns if c not in ("series_id", "ts"))).orderBy("series_id", "ts").collect() for x in (got, want))
        assert len(a) == len(b)
        for p, q in zip(a, b, strict=True):
            assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(p, q, strict=True)), (p, q)
    lags = diagnostics.autocov_sums(kept, "close", 30)
    assert not shuffles_before_window(lags)
    for stat in (lambda d: diagnostics.autocov_sums(d, "close", 30).select("series_id", F.explode("s").alias("v")),
                 lambda d: diagnostics.kpss(d, "close").select("series_id", F.col("kpss_stat").alias("v")),
                 lambda d: summary.describe(d, "close").select("series_id", F.col("p25").alias("v")),
                 lambda d: fe.backfill(d, ["close"]).select("series_id", F.col("close").alias("v"))):
        a, b = (sorted((r[0], -1e9 if r[1] is None else r[1]) for r in stat(d).collect()) for d in (kept, df))
        assert np.allclose([x[1] for x in a], [x[1] for x in b], rtol=1e-9, atol=1e-6) and [x[0] for x in a] == [x[0] for x in b]


def test_stored_layout_is_found_again_by_its_files(spark, walks):
    path = f"{checkpoint_dir(spark).rstrip('/')}/layouts/again-{uuid.uuid4().hex}"
    layout.store(frame(spark, walks), size=200, before=16, after=16, path=path)
    again = layout.attach(spark, path, f"again_{uuid.uuid4().hex[:8]}")
    assert not shuffles_before_window(fe.rolling(again, windows=(5,), std_windows=()))
    wide = fe.rolling(again, windows=(40,), std_windows=())  # reaches further than the stored copies
    want = fe.rolling(frame(spark, walks), windows=(40,), std_windows=())
    assert sorted(map(tuple, wide.select("series_id", "ts", F.round("sma_40", 8)).collect()), key=str) == \
        sorted(map(tuple, want.select("series_id", "ts", F.round("sma_40", 8)).collect()), key=str)


def test_stored_layout_with_missing_values(spark):
    rng = np.random.default_rng(1)
    v = [None if k % 7 == 3 else x for k, x in enumerate(rng.standard_normal(400))]
    df = frame(spark, {"a": v, "b": list(rng.standard_normal(50))})
    a, b = (diagnostics.acf(diagnostics.autocov_sums(d, "close", 20), 20).orderBy("series_id", "lag").collect() for d in (layout.store(df, size=90), df))
    assert [(x["series_id"], x["n"], x["lag"]) for x in a] == [(x["series_id"], x["n"], x["lag"]) for x in b]
    assert np.allclose([x["acf"] for x in a], [x["acf"] for x in b])


# ---- statistics kept up to date ---------------------------------------------------------------------------

def test_appends_give_the_batch_statistics(spark, walks):
    df = frame(spark, walks)
    state = None
    cuts = ["2020-01-01", "2020-01-04", "2020-01-05", "2020-03-01", "2020-09-09", "2021-03-03", "2021-03-04", "2021-10-10", "2022-05-05", "2023-01-01", "2030-01-01"]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        state = incremental.update(state, df.where(f"ts >= '{lo}' AND ts < '{hi}'"))
    for live, batch, cols in (
            (diagnostics.ljung_box(incremental.autocov_sums(state), 10), diagnostics.ljung_box(diagnostics.autocov_sums(df, "close", 10), 10), ["n", "lb_stat", "lb_pvalue"]),
            (incremental.kpss(state), diagnostics.kpss(df, "close"), ["n", "kpss_lags", "kpss_stat", "kpss_pvalue"]),
            (incremental.describe(state), summary.describe(df, "close"), ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])):
        a, b = (x.orderBy("series_id").collect() for x in (live, batch))
        assert [r["series_id"] for r in a] == [r["series_id"] for r in b] == ["a", "b", "c", "d"]
        for p, q in zip(a, b, strict=True):
            for c in cols:
                assert (p[c] is None) == (q[c] is None) and (p[c] is None or math.isclose(p[c], q[c], rel_tol=1e-7, abs_tol=1e-9)), (c, p, q)
    with pytest.raises(ValueError):
        incremental.update(state, df.where("ts = '2020-02-02'"))
    same = incremental.update(state, df.where("ts > '2040-01-01'"))
    assert same.series.count() == 4 and same.series.agg(F.sum("n")).first()[0] == df.count()


# ---- boosting ------------------------------------------------------------------------------------------------

def brute_boost(x, y, rounds, depth, eta, l2, cuts):
    """Boosting by trying every cut at every node (missing values to the left or the right)."""
    unit = 2.0 ** (math.frexp(np.abs(y).max())[1] + 1 - 30)
    base = np.floor(y / unit + 0.5).sum() / len(y) * unit
    p = np.full(len(y), base)
    for _ in range(rounds):
        g = np.floor((p - y) / unit + 0.5)
        step = np.zeros(len(y))

        def grow(rows, level):
            best = None
            for f in range(x.shape[1]):
                v = x[rows, f]
                for c in cuts[f]:
                    for miss in (True, False):
                        left = np.where(np.isnan(v), miss, v <= c)
                        if 1 <= left.sum() < len(rows):
                            a, n, z, h = g[rows][left].sum() * unit, left.sum(), g[rows].sum() * unit, len(rows)
                            gain = a * a / (n + l2) + (z - a) * (z - a) / (h - n + l2) - z * z / (h + l2)
                            if gain > 0 and (best is None or gain > best[0] * (1 + 1e-12)):
                                best = (gain, left)
            if best is None or level == depth:
                step[rows] = eta * -(g[rows].sum() * unit / (len(rows) + l2))
                return
            grow(rows[best[1]], level + 1)
            grow(rows[~best[1]], level + 1)
        grow(np.arange(len(y)), 0)
        p = p + step
    return p


@pytest.mark.parametrize("missing", [False, True])
def test_boosting_against_every_cut(spark, missing):
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((220, 3)), 1)
    y = np.where(x[:, 0] > 0.3, 5.0, 1.0) + x[:, 1] * np.abs(x[:, 2]) + 0.1 * rng.standard_normal(220)
    if missing:
        x[rng.random(x.shape) < 0.15] = np.nan
    rows = [(*(None if math.isnan(v) else float(v) for v in r), float(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(5)
    model = boosting.fit(df, ["a", "b", "c"], "y", rounds=10, depth=3, eta=0.3, bins=16)
    got = model.predict(df).select("y", "prediction").collect()
    want = brute_boost(x, y, 10, 3, 0.3, 1.0, model.cuts)
    assert np.allclose(sorted(r["prediction"] for r in got), sorted(want))
    assert np.mean([(r["prediction"] - r["y"]) ** 2 for r in got]) < 0.5 * y.var()
    again = boosting.fit(df.repartition(2), ["a", "b", "c"], "y", rounds=10, depth=3, eta=0.3, bins=16)
    assert [(t.feature, t.cut, t.weight) for t in again.trees] == [(t.feature, t.cut, t.weight) for t in model.trees]


def test_boosting_of_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0)] * 30 + [(None, None, None)], "a double, b double, y double")
    model = boosting.fit(df, ["a", "b"], "y", rounds=3, depth=2)
    assert {round(r["prediction"], 6) for r in model.predict(df).collect()} == {7.0}


def test_cuts_part_the_ranks_evenly(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.standard_normal(900), np.full(300, 0.25)])
    df = spark.createDataFrame([(float(a), float(i % 3)) for i, a in enumerate(v)], "a double, b double").repartition(6)
    cuts = boosting.quantile_cuts(df, ["a", "b"], 12)
    s = np.sort(v)
    want = sorted({s[r] for r in range(len(s)) if ((r + 1) * 12) // len(s) > (r * 12) // len(s)} - {s[-1]})
    assert cuts[0].tolist() == want and cuts[1].tolist() == [0.0, 1.0]


# ---- permutations ------------------------------------------------------------------------------------------------

def test_permutation_is_one_to_one_and_looks_random():
    for n in (1, 2, 3, 10, 1_000, 99_991):
        for key in (0, 5, 10 ** 12):
            assert np.array_equal(np.sort(ranks.permute(np.arange(n), n, key)), np.arange(n))
    p, q = (ranks.permute(np.arange(50_000), 50_000, k) for k in (1, 2))
    assert abs(np.corrcoef(np.arange(50_000), p)[0, 1]) < 0.02 and abs(np.corrcoef(p[1:], p[:-1])[0, 1]) < 0.02 and abs(np.corrcoef(p, q)[0, 1]) < 0.02
    assert (p == np.arange(50_000)).sum() < 12


def test_row_numbers(spark):
    df = spark.range(5_000).select(F.pmod(F.xxhash64("id"), F.lit(977)).alias("v"), "id").repartition(7)
    got = [(r["v"], r["id"], r["_row"]) for r in ranks.row_numbers(df, ["v", "id"]).collect()]
    assert [r[2] for r in sorted(got)] == list(range(5_000))


def test_permutation_importance_takes_one_permutation_of_all_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2_000, 2))
    df = spark.createDataFrame([(i, float(a), float(b), float(3 * a + b)) for i, (a, b) in enumerate(x)], "id long, x1 double, x2 double, y double")
    model = ml.fit_pipeline(df, ["x1", "x2"], "y", "linear")
    got = {r["feature"]: r["mse_increase_pct"] for r in ml.permutation_importance(
        model, df.withColumn("y", F.col("y") + F.sin("id")), {"x1": ["x1"], "x2": ["x2"], "both": ["x1", "x2"]}, label="y", seed=3, order=["id"]).collect()}
    noise = np.sin(np.arange(2_000))
    base = (noise ** 2).mean()
    for k, (name, cols) in enumerate((("x1", [0]), ("x2", [1]), ("both", [0, 1]))):
        z = x.copy()
        z[:, cols] = x[ranks.permute(np.arange(2_000), 2_000, 3 + 17 * k)][:, cols]
        want = (((x @ [3, 1] + noise) - z @ [3, 1]) ** 2).mean()
        assert got[name] == pytest.approx((want - base) / base * 100, rel=1e-3)


# ---- summaries of odd values ---------------------------------------------------------------------------------------

def test_quantiles_end_with_infinite_values(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.standard_normal(3_000) * 1e-3, [math.inf] * 40, [-math.inf] * 30, [1e300, -1e300, math.nan]])
    df = spark.createDataFrame([("a", float(x)) for x in v], "series_id string, close double")
    got = {r["q"]: r["value"] for r in summary.exact_quantiles(df, "close", [0.0, 0.005, 0.25, 0.5, 0.999, 1.0], rank_values=50).collect()}
    s = np.sort(v[~np.isnan(v)])
    for q, x in got.items():
        h = (len(s) - 1) * q
        a, b = s[math.floor(h)], s[math.ceil(h)]
        assert x == (a if a == b or h == math.floor(h) else pytest.approx(a + (h - math.floor(h)) * (b - a)))


def test_one_outlier_does_not_fail_the_others(spark):
    rng = np.random.default_rng(6)
    rows = [("far", float(x)) for x in [*rng.standard_normal(1_000), 1e15]] + [("fine", float(x)) for x in rng.standard_normal(500)] + \
        [("inf", 1.0), ("inf", math.inf), ("flat", 2.0), ("flat", 2.0), ("nan", math.nan)]
    h = summary.histogram(spark.createDataFrame(rows, "series_id string, close double"), "close", bins="auto").collect()
    by = {}
    for r in h:
        by.setdefault(r["series_id"], []).append(r)
    assert [(r["bin"], r["count"], r["reason"]) for r in by["far"]] == [(None, 1_001, "more than 100000 bins")]
    assert [(r["bin"], r["count"], r["reason"]) for r in by["inf"]] == [(None, 2, "infinite value")]
    assert sum(r["count"] for r in by["fine"]) == 500 and len(by["fine"]) > 5 and all(r["reason"] is None for r in by["fine"])
    assert [(r["bin"], r["count"]) for r in by["flat"]] == [(0, 2)] and "nan" not in by
