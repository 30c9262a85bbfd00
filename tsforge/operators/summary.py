"""Per-series summary statistics (A3-A7): describe, exact quantiles, histogram, KDE.

Exact quantiles never sort a whole group in one task: values are counted in cells of the range
that holds a wanted rank, and only the few distinct values of the last such range are ranked.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.columns import safe_div
from tsforge.operators import segments as sg
from tsforge.session import materialize, reuse_input

SQRT_2PI = math.sqrt(2.0 * math.pi)
LARGEST = 1.7976931348623157e308
MAX_BINS = 100_000  # of one series' histogram


def exact_quantiles(df: DataFrame, value: str, qs: list[float], key="series_id", rank_values: int = 200_000,
                    cells: int = 1000) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas / ``quantile_cont``) per group.

    Returns ``key, q, value``. Wanted are the values of ranks r0 = floor((n-1) q) and
    r1 = ceil((n-1) q). Equal values are first counted together, so ties cost nothing. While the
    range that holds a group's ranks has more than ``rank_values`` distinct values, it is cut into
    ``cells`` of equal width; the cells' row counts say in which of them the ranks lie (so a range
    always holds its ranks), and the range shrinks to the values of those. What is left is ranked
    with a window per (group, q). NaN counts as missing; infinite values rank below and above all
    others, in the first and the last cell, so the range that is left is finite."""
    keys = [key] if isinstance(key, str) else list(key)
    d = reuse_input(sg.home_rows(df).select(*keys, F.nanvl(F.col(value).cast("double"), F.lit(None)).alias("_v")).filter(F.col("_v").isNotNull())
                      .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    return quantiles_of_counts(d, qs, keys, rank_values, cells)


def quantiles_of_counts(d: DataFrame, qs: list[float], keys: list[str], rank_values: int = 200_000, cells: int = 1000) -> DataFrame:
    """``exact_quantiles`` of a table of value counts: keys, ``_v`` (distinct), ``_c``."""
    n = d.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_m"))
    qrow = F.explode(F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(q)).alias("q")) for i, q in enumerate(qs)]))
    h = (F.col("_n") - 1) * F.col("q")
    st = (n.select(*keys, "_n", "_lo", "_hi", "_m", qrow.alias("_q")).select(*keys, "_n", "_lo", "_hi", "_m", "_q.*")
           .withColumn("_r0", F.floor(h).cast("bigint")).withColumn("_r1", F.ceil(h).cast("bigint"))
           .withColumn("_fr", h - F.floor(h)).withColumn("_below", F.lit(0).cast("bigint")))
    st = materialize(st)
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))

    def half(x):  # halves of the values, the infinite ones at the ends of what a double holds: no difference overflows
        return F.greatest(F.least(F.col(x), F.lit(LARGEST)), F.lit(-LARGEST)) / 2.0

    left = None
    while (most := st.agg(F.max("_m")).first()[0] or 0) > rank_values:
        if left is not None and most >= left:
            raise RuntimeError(f"{most} values between two neighbouring ranks could not be parted")
        left = most
        cell = F.least(F.floor(safe_div(half("_v") - half("_lo"), half("_hi") - half("_lo")) * cells), F.lit(cells - 1))
        got = d.join(st, keys).filter(inside).groupBy(*keys, "qi", F.coalesce(cell, F.lit(0)).alias("_cell")).agg(
            F.sum("_c").alias("_rows"), F.count(F.lit(1)).alias("_mm"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        w = Window.partitionBy(*keys, "qi").orderBy("_cell")  # at most ``cells`` rows
        got = got.join(st, keys + ["qi"]).withColumn("_from", F.sum("_rows").over(w) - F.col("_rows") + F.col("_below"))
        hit = (F.col("_from") <= F.col("_r1")) & (F.col("_from") + F.col("_rows") > F.col("_r0"))
        nx = got.filter(hit).groupBy(*keys, "qi").agg(F.min("_a").alias("_lo2"), F.max("_b").alias("_hi2"),
                                                       F.sum("_mm").alias("_m2"), F.min("_from").alias("_below2"))
        st = materialize(st.drop("_lo", "_hi", "_m", "_below").join(nx, keys + ["qi"])
                         .withColumnsRenamed({"_lo2": "_lo", "_hi2": "_hi", "_m2": "_m", "_below2": "_below"}))
    w = Window.partitionBy(*keys, "qi").orderBy("_v")
    ranked = d.join(st, keys).filter(inside).withColumn("_to", F.sum("_c").over(w) + F.col("_below")) \
        .withColumn("_from", F.col("_to") - F.col("_c"))
    pick = ranked.filter((F.col("_from") <= F.col("_r1")) & (F.col("_to") > F.col("_r0")))
    out = pick.groupBy(*keys, "qi", "q", "_fr").agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    between = F.when((F.col("_a") == F.col("_b")) | (F.col("_fr") == 0), F.col("_a")).otherwise(F.col("_a") + F.col("_fr") * (F.col("_b") - F.col("_a")))
    return out.select(*keys, "q", between.alias("value"))


def describe(df: DataFrame, value: str = "close", key="series_id") -> DataFrame:
    """A4: count, mean, sample std, min, 25/50/75 % (exact, interpolated), max per series. NaN counts
    as missing; a series with an infinite value has no mean and no std (null)."""
    df = reuse_input(sg.home_rows(df).select(key, F.nanvl(F.col(value).cast("double"), F.lit(None)).alias(value)))
    finite = F.when(F.abs(F.col(value)) < math.inf, F.col(value))
    whole = F.count(finite) == F.count(value)
    base = df.groupBy(key).agg(F.count(value).cast("bigint").alias("count"), F.when(whole, F.avg(finite)).alias("mean"),
                               F.when(whole, F.stddev_samp(finite)).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    qs = exact_quantiles(df, value, [0.25, 0.5, 0.75], key)
    wide = qs.groupBy(key).pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    wide = wide.toDF(key, "p25", "p50", "p75")
    return base.join(wide, key, "left")


def std_pop(df: DataFrame, value: str, key="series_id") -> DataFrame:
    """A3: population standard deviation (ddof 0) per series."""
    return sg.home_rows(df).groupBy(key).agg(F.stddev_pop(value).alias("std_pop"))


def _bin_count(rule: str):
    """Bin count per series for a numpy rule: 'sturges' (range / (log2 n + 1) wide),
    'sqrt', 'fd' (2 IQR n^(-1/3) wide) or 'auto' (the narrower of Sturges and FD, Sturges when
    the IQR is 0) - seaborn's default."""
    n = F.col("_n").cast("double")
    rng = F.col("_hi") - F.col("_lo")
    if rule == "sqrt":
        return F.ceil(F.sqrt(n)).cast("double")
    sturges_w = rng / (F.log2(n) + 1.0)
    fd_w = 2.0 * F.col("_iqr") * F.pow(n, -1.0 / 3.0)
    width = {"sturges": sturges_w,
             "fd": fd_w,
             "auto": F.when(fd_w > 0, F.least(fd_w, sturges_w)).otherwise(sturges_w)}[rule]
    ratio = F.try_divide(rng, width)
    return F.greatest(F.coalesce(F.when(ratio < 2.0 ** 53, F.ceil(F.least(ratio, F.lit(2.0 ** 53))).cast("double")).otherwise(ratio), F.lit(1.0)), F.lit(1.0))


def histogram(df: DataFrame, value: str = "close", bins=20, key="series_id", max_bins: int = MAX_BINS) -> DataFrame:
    """A5: equal-width histogram per series between its min and max (numpy convention: the last
    bin is closed on the right), empty bins included. ``bins`` is a count or a numpy rule: 'auto'
    (seaborn's default), 'fd', 'sturges', 'sqrt'. NaN counts as missing. A series with an infinite
    value, or whose rule asks for more than ``max_bins`` bins (one far outlier does), gets a single
    row with a null bin, all its values and a ``reason``; the others are not touched by it."""
    df = reuse_input(sg.home_rows(df).select(key, F.nanvl(F.col(value).cast("double"), F.lit(None)).alias(value)))
    st = df.groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n"))
    if isinstance(bins, int):
        nb = F.lit(float(bins))
    else:
        if bins in ("fd", "auto"):
            q = exact_quantiles(df, value, [0.25, 0.75], key)
            iqr = q.groupBy(key).agg((F.max_by("value", "q") - F.min_by("value", "q")).alias("_iqr"))
            st = st.join(iqr, key, "left")
        nb = _bin_count(bins)
    why = F.when((F.abs("_lo") == math.inf) | (F.abs("_hi") == math.inf), F.lit("infinite value")) \
        .when(F.col("_nb") > max_bins, F.lit(f"more than {max_bins} bins"))
    st = sg._maybe_broadcast(st.withColumn("_nb", nb).withColumn("reason", why)
                             .withColumn("_nb", F.when(F.col("reason").isNull(), F.col("_nb")).cast("int")).where("_n > 0"))
    fine = st.where("reason IS NULL")
    j = df.select(key, value).filter(F.col(value).isNotNull()).join(fine, key)
    pos = safe_div(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo")) * F.col("_nb")
    b = F.least(F.coalesce(F.floor(pos), F.lit(0)), F.col("_nb") - 1).cast("int")
    got = j.groupBy(F.col(key), b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = fine.select(key, "_lo", "_hi", "_nb", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_nb")
    out = every.join(got, [key, "bin"], "left").select(
        key, F.col("bin").cast("int").alias("bin"), (F.col("_lo") + F.col("bin") * width).alias("lo_edge"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi_edge"), F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        F.lit(None).cast("string").alias("reason"))
    return out.unionByName(st.where("reason IS NOT NULL").select(
        key, F.lit(None).cast("int").alias("bin"), F.col("_lo").alias("lo_edge"), F.col("_hi").alias("hi_edge"),
        F.col("_n").cast("bigint").alias("count"), "reason"))


KDE_BINS = 200   # bins for each bandwidth
KDE_REACH = 9.0  # bandwidths beyond which the kernel is below 1e-17


def _kde_partial(grid: int):
    """Density sums of the bins of each Arrow batch at the grid points within reach."""
    def run(it):
        for pdf in it:
            for sid, g in pdf.groupby("series_id", sort=False):
                h, x0, step = (float(g[c].iloc[0]) for c in ("_h", "_x0", "_gs"))
                m, c, s2 = g["_mean"].to_numpy(), g["_c"].to_numpy(), g["_s2"].to_numpy()
                out = np.zeros(grid)
                first = np.clip(np.floor((m - KDE_REACH * h - x0) / step) if step > 0 else np.zeros(len(m)), 0, grid).astype(int)
                last = np.clip(np.ceil((m + KDE_REACH * h - x0) / step) if step > 0 else np.zeros(len(m)), -1, grid - 1).astype(int)
                for k in range(int((last - first).max(initial=-1)) + 1):
                    at = first + k
                    on = at <= last
                    u = (x0 + at[on] * step - m[on]) / h
                    # kernel at the bin's mean, and the second-order term of the spread about it
                    np.add.at(out, at[on], np.exp(-0.5 * u * u) * (c[on] + 0.5 * s2[on] / (h * h) * (u * u - 1.0)))
                yield pd.DataFrame({"series_id": [sid], "_d": [out.tolist()]})
    return run


def kde(df: DataFrame, value: str = "close", grid: int = 200, cut: float = 0.0, key: str = "series_id") -> DataFrame:
    """Gaussian kernel density per series on ``grid`` points spanning min - cut*h .. max + cut*h,
    bandwidth by Scott's rule h = std * n^(-1/5).

    Values are first gathered in bins of width h / 200 (a partial aggregate), each kept as its
    count, mean and spread; the kernel is expanded to second order about the bin's mean, which
    leaves a relative error near 1e-8 at any size, for the bins follow the bandwidth. Bins reach
    only the grid points within nine bandwidths. A constant series has no density (null)."""
    df = reuse_input(sg.home_rows(df).select(F.col(key).alias("series_id"), F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull()))
    st = df.groupBy("series_id").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n"),
                                     F.stddev_samp("_v").alias("_sd"))
    st = st.withColumn("_h", F.when(F.col("_lo") < F.col("_hi"), F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))))
    st = sg._maybe_broadcast(st.withColumn("_x0", F.col("_lo") - cut * F.coalesce("_h", F.lit(0.0)))
                             .withColumn("_gs", (F.col("_hi") - F.col("_lo") + 2 * cut * F.coalesce("_h", F.lit(0.0))) / (grid - 1)))
    j = df.join(st.where("_h > 0"), "series_id")
    off = F.col("_v") - F.col("_lo")
    b = F.floor(off / F.col("_h") * KDE_BINS)
    base = F.col("_b") * F.col("_h") / KDE_BINS  # offsets from the bin's edge keep the spread accurate
    e = j.withColumn("_b", b).withColumn("_o", off - base)
    bins = e.groupBy("series_id", "_b", "_lo", "_h", "_x0", "_gs").agg(
        F.count(F.lit(1)).cast("double").alias("_c"), F.avg("_o").alias("_om"), F.sum(F.col("_o") * F.col("_o")).alias("_oo"))
    bins = bins.select("series_id", "_h", "_x0", "_gs", "_c", (F.col("_lo") + base + F.col("_om")).alias("_mean"),
                       F.greatest(F.col("_oo") - F.col("_c") * F.col("_om") * F.col("_om"), F.lit(0.0)).alias("_s2"))
    part = bins.sortWithinPartitions("series_id").mapInPandas(_kde_partial(grid), "series_id string, _d array<double>")
    dens = part.select("series_id", F.posexplode("_d").alias("g", "d")).groupBy("series_id", "g").agg(F.sum("d").alias("_s"))
    every = st.select("series_id", "_n", "_h", "_x0", "_gs", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
    return (every.join(dens, ["series_id", "g"], "left")
             .select(F.col("series_id").alias(key), F.col("g").cast("int").alias("grid_index"),
                     (F.col("_x0") + F.col("g") * F.col("_gs")).alias("x"),
                     safe_div(F.coalesce("_s", F.when(F.col("_h") > 0, 0.0)), F.col("_n") * F.col("_h") * SQRT_2PI).alias("density")))
