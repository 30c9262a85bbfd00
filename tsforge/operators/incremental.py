"""Statistics kept up to date from new bars only (A3, A4, T2-T6 on live data).

A state holds, for each series, sums that merge exactly: count, sum, extremes, lagged products, the sums
that the running total of the series enters the KPSS statistic with, and its first and last ``MAX_LAG``
values, over which products of an append reach back; and a table of value counts for exact quantiles.
``update`` reads the new bars and the state, never the old bars. Values are taken as offsets from the
series' first value, which keeps the sums small.

With x the offsets, m their mean and C_t their running total, the centred statistics follow from

    S_k = sum x_t x_{t-k} - m (sum_{t>k} x_t + sum_{t<=n-k} x_t) + (n - k) m^2
    sum_t (C_t - t m)^2 = sum C_t^2 - 2 m sum t C_t + m^2 sum t^2

so ``autocov_sums`` gives what ``diagnostics.autocov_sums`` gives over all bars, and ``ljung_box``,
``acf``, ``pacf_yw`` take it as it is.

New bars of a series must lie after all it has seen (late ones raise). Null and NaN values are left
out. A series that is new to the state starts there; a series without new bars stays as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import diagnostics, segments as sg, summary
from tsforge.session import materialize, reuse_input

MAX_LAG = 40


@dataclass
class SeriesState:
    """``series``: one row for each series; ``values``: series_id, value, count."""
    series: DataFrame
    values: DataFrame
    max_lag: int = MAX_LAG


def _lag_products(rows: DataFrame, max_lag: int) -> DataFrame:
    """series_id, lx: sum of x_t x_{t-k} for k = 0..max_lag over the new rows t. ``rows`` holds
    ``_pos``, x and ``new``; the old ones are the last values seen before."""
    lags = {f"_l{k}": (lambda k: lambda w: F.lag("x", k).over(w))(k) for k in range(1, max_lag + 1)}
    seg = sg.segmented(rows, before=max_lag)
    w = sg.segment_window("series_id")
    d = sg.drop_halo(seg.withColumns({n: b(w) for n, b in lags.items()})).where("new")
    sums = [F.sum(F.col("x") * F.col("x"))] + [F.sum(F.col("x") * F.col(f"_l{k}")) for k in range(1, max_lag + 1)]
    return d.groupBy("series_id").agg(F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums]).alias("lx"))


def _ends(rows: DataFrame, max_lag: int) -> DataFrame:
    """series_id, head, tail: the first and the last ``max_lag`` new values in order."""
    def edge(cond, name):
        got = rows.where(cond).groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("_pos", "x"))).alias("v"))
        return got.select("series_id", F.transform("v", lambda s: s["x"]).alias(name))
    return edge(F.col("_pos") <= max_lag, "h2").join(edge(F.col("_pos") > F.col("_len") - max_lag, "t2"), "series_id")


def update(state: SeriesState | None, bars: DataFrame, value: str = "close", key: str = "series_id", ts: str = "ts",
           max_lag: int = MAX_LAG, unit: str = "auto") -> SeriesState:
    """The state after ``bars`` (unique in key and ts). Reads the new bars and one row for each series,
    and merges the value counts."""
    max_lag = state.max_lag if state else max_lag
    v = F.nanvl(F.col(value).cast("double"), F.lit(None))
    new = reuse_input(sg.home_rows(bars).select(F.col(key).alias("series_id"), F.col(ts).alias("ts"), v.alias("v")).where("v IS NOT NULL"))
    first = new.groupBy("series_id").agg(F.min_by("v", "ts").alias("v0"), F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    if state is not None:
        old = state.series.select("series_id", "ref", "n", "last_ts", "tail")
        first = first.join(old, "series_id", "left")
    else:
        empty = {"ref": "double", "n": "bigint", "tail": "array<double>"}
        first = first.withColumns({c: F.lit(None).cast(t) for c, t in empty.items()}).withColumn("last_ts", F.lit(None).cast(new.schema["ts"].dataType))
    head = materialize(first.select("series_id", "t0", "t1", "last_ts", F.coalesce("ref", "v0").alias("ref"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_old"), "tail"))
    late = head.where("last_ts >= t0").select("series_id").first()
    if late:
        raise ValueError(f"bars of {late[0]} are not later than those already counted")

    pos = sg.with_positions(new, "series_id", "ts", unit, with_len=True)
    x = reuse_input(pos.join(head.select("series_id", "ref", "n_old"), "series_id").select(
        "series_id", "_pos", "_len", "n_old", (F.col("v") - F.col("ref")).alias("x"), "v"))
    before = head.where("size(tail) > 0").select("series_id", F.posexplode("tail").alias("i", "x"), F.size("tail").alias("m"))
    shifted = x.join(head.select("series_id", F.coalesce(F.size("tail"), F.lit(0)).alias("m")), "series_id") \
        .select("series_id", (F.col("_pos") + F.greatest("m", F.lit(0))).cast("bigint").alias("_pos"), "x", F.lit(True).alias("new"))
    products = _lag_products(before.select("series_id", (F.col("i") + 1).cast("bigint").alias("_pos"), "x", F.lit(False).alias("new"))
                             .unionByName(shifted), max_lag)
    c = sg.running_sum(x, "x", "c")
    part = c.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("m"), F.sum("x").alias("x1"), F.sum(F.col("x") * F.col("x")).alias("x2"), F.sum("c").alias("c1"),
        F.sum(F.col("c") * F.col("c")).alias("c2"), F.sum(F.col("_pos") * F.col("c")).alias("jc"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    add = part.join(products, "series_id").join(_ends(x, max_lag), "series_id").join(head.select("series_id", "ref", "t1"), "series_id")
    if state is None:
        s = add.select("series_id", "ref", F.col("m").alias("n"), F.col("t1").alias("last_ts"), F.col("x1").alias("sx"), F.col("x2").alias("sxx"),
                       F.col("c2").alias("scc"), F.col("jc").alias("stc"), "lo", "hi", F.col("lx"), F.col("h2").alias("head"), F.col("t2").alias("tail"))
        vals = x.groupBy("series_id", F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("count"))
        return SeriesState(materialize(s), materialize(vals), max_lag)

    a = add.drop("ref").withColumnRenamed("t1", "new_ts").withColumnsRenamed({"lo": "lo2", "hi": "hi2", "lx": "lx2"})
    j = state.series.join(a, "series_id", "full")
    new_ref = add.select("series_id", F.col("ref").alias("ref2"))
    j = j.join(new_ref, "series_id", "left")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0.0))
    n, m, total = F.coalesce("n", F.lit(0)).cast("bigint"), F.coalesce("m", F.lit(0)).cast("bigint"), z("sx")  # total: running sum so far
    no = F.array().cast("array<double>")
    # C_t = total + c_j and t = n + j for the new rows j = 1..m
    scc = z("scc") + m * total * total + 2.0 * total * z("c1") + z("c2")
    stc = z("stc") + n * m * total + n * z("c1") + total * (m * (m + 1) / 2.0) + z("jc")
    zip_add = F.when(F.col("lx").isNull(), F.col("lx2")).when(F.col("lx2").isNull(), F.col("lx")).otherwise(F.zip_with("lx", "lx2", lambda p, q: p + q))
    heads = F.slice(F.concat(F.coalesce("head", no), F.coalesce("h2", no)), 1, max_lag)
    tails = F.concat(F.coalesce("tail", no), F.coalesce("t2", no))
    s = j.select("series_id", F.coalesce("ref", "ref2").alias("ref"), (n + m).alias("n"), F.coalesce("new_ts", "last_ts").alias("last_ts"),
                 (total + z("x1")).alias("sx"), (z("sxx") + z("x2")).alias("sxx"), scc.alias("scc"), stc.alias("stc"),
                 F.least("lo", "lo2").alias("lo"), F.greatest("hi", "hi2").alias("hi"), zip_add.alias("lx"), heads.alias("head"),
                 F.slice(tails, F.greatest(F.lit(1), F.size(tails) - max_lag + 1), F.lit(max_lag)).alias("tail"))
    vals = state.values.unionByName(x.groupBy("series_id", F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("count"))) \
        .groupBy("series_id", "value").agg(F.sum("count").alias("count"))
    return SeriesState(materialize(s), materialize(vals), max_lag)


def autocov_sums(state: SeriesState) -> DataFrame:
    """``series_id, n, mean, s`` like ``diagnostics.autocov_sums``, exactly 0 for a constant series."""
    n, mu = F.col("n"), F.col("sx") / F.col("n")

    def total(arr, k):  # of the first, or last, k values
        return F.aggregate(F.slice(arr, 1, k) if arr == "head" else F.slice(arr, F.greatest(F.lit(1), F.size(arr) - k + 1), F.lit(k)),
                           F.lit(0.0), lambda acc, y: acc + y) if k else F.lit(0.0)
    s = [F.when((F.col("lo") == F.col("hi")) | (n <= k), 0.0).otherwise(
        F.col("lx")[k] - mu * (2.0 * F.col("sx") - total("head", k) - total("tail", k)) + (n - k) * mu * mu) for k in range(state.max_lag + 1)]
    return state.series.select("series_id", "n", (F.col("ref") + mu).alias("mean"), F.array(*s).alias("s"))


def kpss(state: SeriesState) -> DataFrame:
    """T2 from the state, as ``diagnostics.kpss``. A series whose bandwidth asks for more lags than the
    state keeps has a null statistic and a ``kpss_reason``."""
    n, mu = F.col("n").cast("double"), F.col("sx") / F.col("n")
    squares = n * (n + 1.0) * (2.0 * n + 1.0) / 6.0
    eta = state.series.select("series_id", F.when(F.col("lo") < F.col("hi"), F.col("scc") - 2.0 * mu * F.col("stc") + mu * mu * squares).alias("_ss"))
    return diagnostics.kpss_from(autocov_sums(state), eta)


def describe(state: SeriesState) -> DataFrame:
    """A4 from the state: count, mean, sample std, min, exact quartiles, max."""
    base = state.series.select(
        "series_id", F.col("n").alias("count"), (F.col("ref") + F.col("sx") / F.col("n")).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) / (F.col("n") - 1))).alias("std"),
        F.col("lo").alias("min"), F.col("hi").alias("max"))
    qs = summary.quantiles_of_counts(state.values.withColumnRenamed("value", "_v").withColumnRenamed("count", "_c"), [0.25, 0.5, 0.75], ["series_id"])
    wide = qs.groupBy("series_id").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value")).toDF("series_id", "p25", "p50", "p75")
    return base.join(wide, "series_id", "left")
