"""Per-series window features.

All features are built from one window spec (series, ordered by time), so adjacent
features share a single exchange and sort. By default the series are laid out in bounded
segments with halo rows (``segments.py``), so a very long series is spread over many
tasks while every bounded look-back stays exact.
"""

from __future__ import annotations

import inspect
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tsforge.functions.columns import c, pos_part, safe_div
from tsforge.operators import segments as sg

Builder = Callable[[WindowSpec], Column]

EMA_TAIL = 200  # rows folded by ``ema_fold``; the dropped tail weighs (1-a)^199


@dataclass
class Ctx:
    """What a builder may need besides the window: the partition columns and the order column."""
    part: list
    order: str


def _call(b, w, ctx):
    return b(w, ctx) if len(inspect.signature(b).parameters) > 1 else b(w)


def windowed(df: DataFrame, steps: list[dict[str, Builder]], before: int = 0, after: int = 0,
             key: str = "series_id", ts: str = "ts", layout: str = "segmented",
             size: int = sg.DEFAULT_SEGMENT_ROWS, unit: str = "auto", keep_pos: bool = False) -> DataFrame:
    """Add window columns in ``steps`` (each step a dict name -> builder(window[, ctx])).

    Later steps may use columns of earlier ones; all steps share the same partitioning.
    ``before``/``after`` are the widest frame reach in rows over all builders.
    """
    if layout == "series":  # reference layout (one task per series), used to check the segmented one
        w = Window.partitionBy(key).orderBy(ts)
        ctx = Ctx([key], "_rowpos")
        d = sg.home_rows(df).withColumn("_rowpos", F.row_number().over(w))
        for step in steps:
            d = d.withColumns({n: _call(b, w, ctx) for n, b in step.items()})
        return d.drop("_rowpos")
    d = sg.series_layout(df, before, after, key, ts, size, unit)
    w = sg.segment_window(key)
    ctx = Ctx([key, sg.SEG], sg.POS)
    for step in steps:
        d = d.withColumns({n: _call(b, w, ctx) for n, b in step.items()})
    d = sg.drop_halo(d)
    return d if keep_pos else d.drop(sg.POS)


# ---- column builders: each takes the ordered series window -----------------------------

def diff(v) -> Builder:
    return lambda w: c(v) - F.lag(c(v), 1).over(w)


def log_return(v) -> Builder:
    return lambda w: F.ln(safe_div(c(v), F.lag(c(v), 1).over(w)))


def pct_change(v) -> Builder:
    return lambda w: (safe_div(c(v), F.lag(c(v), 1).over(w)) - 1.0) * 100.0


def rolling_mean(v, k: int) -> Builder:
    """Mean of the last ``k`` rows; null until ``k`` non-null values are in the frame."""
    def b(w):
        fr = w.rowsBetween(-(k - 1), 0)
        return F.when(F.count(c(v)).over(fr) == k, F.avg(c(v)).over(fr))
    return b


def rolling_std(v, k: int) -> Builder:
    """Sample standard deviation of the last ``k`` rows, null until the frame is full."""
    def b(w):
        fr = w.rowsBetween(-(k - 1), 0)
        return F.when(F.count(c(v)).over(fr) == k, F.stddev_samp(c(v)).over(fr))
    return b


def ema_fold(v, span: int, tail: int = EMA_TAIL) -> Builder:
    """EMA (adjust=False) folded over the last ``tail`` values (kept as a cross-check of
    ``ema_steps``; costs ``tail`` steps per row)."""
    a = 2.0 / (span + 1.0)

    def b(w):
        xs = F.collect_list(c(v)).over(w.rowsBetween(-(tail - 1), 0))
        return F.aggregate(xs, F.lit(None).cast("double"),
                           lambda acc, x: F.when(acc.isNull(), x).otherwise(acc + F.lit(a) * (x - acc)))
    return b


def ema_block(span: int) -> int:
    """Block length B of the EMA scan: the previous-but-one block weighs (1-a)^B <= 1e-40."""
    d = 1.0 - 2.0 / (span + 1.0)
    return max(1, int(math.ceil(40.0 / -math.log10(d))))


def ema_steps(v, span: int, out: str) -> list[dict[str, Builder]]:
    """Exponential moving average with ``adjust=False`` (y0 = x0, y = (1-a) y + a x,
    a = 2/(span+1)) as an exact block scan, O(1) per row.

    Rows are cut into blocks of B positions. Inside a block the scan from zero is
    d^j * sum_{i<=j} d^-i z_i (d = 1-a, z = a x, z0 = x0) - one running window sum; the value
    entering block b is the previous block's end value (older blocks weigh d^B <= 1e-40).
    Needs ``before = ema_halo(span)`` rows of halo."""
    a = 2.0 / (span + 1.0)
    d = 1.0 - a
    B = ema_block(span)
    p = f"_{out}_"

    def blk(ctx, name):
        return Window.partitionBy(*ctx.part, p + "b").orderBy(ctx.order)

    return [
        {p + "z": lambda w, ctx: F.when(F.col(ctx.order) == 1, c(v)).otherwise(F.lit(a) * c(v)),
         p + "j": lambda w, ctx: F.pmod(F.col(ctx.order) - 1, F.lit(B)),
         p + "b": lambda w, ctx: F.floor((F.col(ctx.order) - 1) / B)},
        {p + "loc": lambda w, ctx: F.pow(F.lit(d), F.col(p + "j")) * F.sum(F.col(p + "z") * F.pow(F.lit(d), -F.col(p + "j")))
            .over(blk(ctx, "loc").rowsBetween(Window.unboundedPreceding, 0))},
        {p + "end": lambda w, ctx: F.last(p + "loc").over(blk(ctx, "end").rowsBetween(Window.unboundedPreceding,
                                                                                     Window.unboundedFollowing))},
        {p + "prev": lambda w, ctx: F.lag(p + "end", 1).over(w)},
        {p + "in": lambda w, ctx: F.first(p + "prev").over(blk(ctx, "in").rowsBetween(Window.unboundedPreceding, 0))},
        {out: lambda w, ctx: F.col(p + "loc") + F.pow(F.lit(d), F.col(p + "j") + 1) * F.coalesce(F.col(p + "in"), F.lit(0.0))},
    ]


def ema_halo(span: int) -> int:
    return 2 * ema_block(span)


def merge_steps(*lists: list[dict]) -> list[dict]:
    """Zip step lists so independent multi-step builders share window passes."""
    n = max(len(x) for x in lists)
    return [{k: v for x in lists if i < len(x) for k, v in x[i].items()} for i in range(n)]


def drop_temp(df: DataFrame, out: str) -> DataFrame:
    return df.drop(*[x for x in df.columns if x.startswith(f"_{out}_")])


def up_ratio(d, k: int = 14) -> Builder:
    """RSI-like ratio mean_k(max(d,0)) / mean_k(|d|); null until ``k`` differences exist and
    null for a flat window (0/0)."""
    def b(w):
        fr = w.rowsBetween(-(k - 1), 0)
        return F.when(F.count(c(d)).over(fr) == k,
                      safe_div(F.avg(pos_part(d)).over(fr), F.avg(F.abs(c(d))).over(fr)))
    return b


def lag_window(v, lookback: int) -> Builder:
    """The ``lookback`` values before the current row, oldest first; null if fewer exist."""
    def b(w):
        xs = F.collect_list(c(v)).over(w.rowsBetween(-lookback, -1))
        return F.when(F.size(xs) == lookback, xs)
    return b


# ---- DataFrame operators -------------------------------------------------------------------

def first_difference(df, value="close", out="diff", drop_first=True, **kw) -> DataFrame:
    r = windowed(df, [{out: diff(value)}], before=1, **kw)
    return r.filter(F.col(out).isNotNull()) if drop_first else r


def log_returns(df, value="close", out="log_return", **kw) -> DataFrame:
    return windowed(df, [{out: log_return(value)}], before=1, **kw)


def pct_changes(df, value="close", out="pct_change", **kw) -> DataFrame:
    return windowed(df, [{out: pct_change(value)}], before=1, **kw)


def rolling(df, value="close", windows=(5, 20, 30), std_windows=(30,), **kw) -> DataFrame:
    cols = {f"sma_{k}": rolling_mean(value, k) for k in windows}
    cols.update({f"std_{k}": rolling_std(value, k) for k in std_windows})
    reach = max(list(windows) + list(std_windows)) - 1
    return windowed(df, [cols], before=reach, **kw)


def ema_feature(df, value="close", span=10, out=None, **kw) -> DataFrame:
    out = out or f"ema_{span}"
    return drop_temp(windowed(df, ema_steps(value, span, out), before=ema_halo(span), **kw), out)


def rsi(df, value="close", k=14, out=None, **kw) -> DataFrame:
    return windowed(df, [{"_d": diff(value)}, {out or f"rsi_{k}": up_ratio("_d", k)}], before=k, **kw).drop("_d")


def technical_features(df, value="close", **kw) -> DataFrame:
    """SMA 5/20, EMA 10 and the 14-row up ratio of one value column, plus log returns and the
    30-row rolling mean/std: the feature set of the original feature-engineering step, for
    every series in one pass over one window spec."""
    steps = merge_steps([
        {"log_return": log_return(value), "_d": diff(value),
         "sma_5": rolling_mean(value, 5), "sma_20": rolling_mean(value, 20),
         "roll_mean_30": rolling_mean(value, 30), "roll_std_30": rolling_std(value, 30)},
        {"rsi_14": up_ratio("_d", 14)},
    ], ema_steps(value, 10, "ema_10"))
    return drop_temp(windowed(df, steps, before=max(30, ema_halo(10)), **kw), "ema_10").drop("_d")


def lag_sequences(df, value="close", lookback=20, out="lags", target="target", **kw) -> DataFrame:
    """Lag windows: for each row with ``lookback`` earlier rows, the array of those earlier
    values and the row's own value as target (n - lookback rows per series)."""
    r = windowed(df, [{out: lag_window(value, lookback)}], before=lookback, **kw)
    return r.filter(F.col(out).isNotNull()).withColumn(target, F.col(value))


def multivariate_sequences(df, features: list[str], target="close", lookback=20, out="lags", **kw) -> DataFrame:
    """Lag windows of several features: ARRAY<STRUCT<features>> of the ``lookback`` earlier rows."""
    st = F.struct(*[F.col(f) for f in features])

    def b(w):
        xs = F.collect_list(st).over(w.rowsBetween(-lookback, -1))
        return F.when(F.size(xs) == lookback, xs)
    r = windowed(df, [{out: b}], before=lookback, **kw)
    return r.filter(F.col(out).isNotNull()).withColumn("target", F.col(target))


def widen(df, arr="lags", prefix="feature_", n=20, fields: list[str] | None = None) -> DataFrame:
    """Window array -> one column per element (``feature_j``; ``{field}_{j}`` for structs)."""
    if fields is None:
        cols = [F.col(arr)[j].alias(f"{prefix}{j}") for j in range(n)]
    else:
        cols = [F.col(arr)[j][f].alias(f"{f}_{j}") for f in fields for j in range(n)]
    return df.select(*[x for x in df.columns if x != arr], *cols)


def backfill(df, cols: list[str], key="series_id", ts="ts", size: int = sg.DEFAULT_SEGMENT_ROWS,
             unit="auto") -> DataFrame:
    """Fill each null with the next non-null value of the same series (pandas ``bfill``).

    Two-level scan: next non-null inside the segment, else the first non-null of the
    nearest later segment (from a per-segment table of first non-null values)."""
    info = sg.stored(df)
    if info and info["size"] <= size:
        d = sg.home_rows(df, keep=True).withColumnRenamed(sg.SEG, "_fs").drop(sg.LEN)
    else:
        d = sg.with_positions(df, key, ts, unit).withColumn("_fs", F.floor((F.col(sg.POS) - 1) / size).cast("bigint"))
    local = Window.partitionBy(key, "_fs").orderBy(sg.POS).rowsBetween(0, Window.unboundedFollowing)
    firsts = d.groupBy(key, "_fs").agg(*[F.min_by(F.col(x), F.when(F.col(x).isNotNull(), F.col(sg.POS))).alias(f"_f_{x}")
                                          for x in cols])
    later = Window.partitionBy(key).orderBy("_fs").rowsBetween(1, Window.unboundedFollowing)
    carry = firsts.select(key, "_fs", *[F.first(f"_f_{x}", ignorenulls=True).over(later).alias(f"_c_{x}") for x in cols])
    out = d.join(sg._maybe_broadcast(carry), [key, "_fs"])
    out = out.withColumns({x: F.coalesce(F.first(F.col(x), ignorenulls=True).over(local), F.col(f"_c_{x}")) for x in cols})
    return out.drop("_fs", sg.POS, *[f"_c_{x}" for x in cols])


def minmax_params(df, value="close", key="series_id", train_col: str | None = None) -> DataFrame:
    """Per-series min and max of ``value`` (over training rows only when ``train_col`` given)."""
    v = F.col(value) if train_col is None else F.when(F.col(train_col), F.col(value))
    return df.groupBy(key).agg(F.min(v).alias("vmin"), F.max(v).alias("vmax"))


def minmax_scale(df, value="close", out="scaled", key="series_id", train_col: str | None = "is_train",
                 params: DataFrame | None = None) -> DataFrame:
    """(v - min) / (max - min) per series, fitted on the rows where ``train_col`` is true (pass
    None to fit on all rows); null for a constant series. The planner broadcasts the table of one
    row per series if its files are small, and shuffles it otherwise."""
    from tsforge.session import reuse_input
    df = reuse_input(df)
    p = params if params is not None else minmax_params(df, value, key, train_col)
    return (df.join(sg._maybe_broadcast(p), key)
              .withColumn(out, safe_div(F.col(value) - F.col("vmin"), F.col("vmax") - F.col("vmin"))))


def minmax_inverse(df, value="scaled", out="unscaled") -> DataFrame:
    """Inverse of ``minmax_scale`` (needs the ``vmin``/``vmax`` columns it adds)."""
    return df.withColumn(out, F.col(value) * (F.col("vmax") - F.col("vmin")) + F.col("vmin"))
