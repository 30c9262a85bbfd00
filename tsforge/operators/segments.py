"""Split long series into bounded segments so window work never needs one task per series.

A window ``partitionBy(series_id).orderBy(ts)`` sends a whole series to one task. When one
series holds a large share of all rows that task becomes the job. The layout here keeps
every window exact while bounding the rows per task:

1. ``with_positions``: global 1-based row position per series, computed in parallel:
   row counts per (series, time bucket) -> running offsets over that small table ->
   ``offset + row_number()`` inside (series, bucket).
2. ``segmented``: cut positions into segments of ``size`` rows and copy the last ``before``
   rows of each segment into the next one (and the first ``after`` rows into the previous
   one). A row frame that looks at most ``before`` rows back / ``after`` rows ahead then
   sees exactly the rows it would see on the whole series.
3. Window functions run over ``segment_window`` (partitioned by series *and* segment), and
   ``drop_halo`` keeps each row once.

Running totals across the whole series (``running_sum``) use the same two-level scan: a
local running sum per segment plus the total of all earlier segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POS = "_pos"
SEG = "_seg"
HOME = "_home"
BUCKET = "_bkt"

DEFAULT_SEGMENT_ROWS = 200_000


def stored(df: DataFrame) -> dict | None:
    """What is known of a frame in the stored layout (``layout.store``): key, ts, size, before, after,
    buckets; None for other frames."""
    if not {POS, SEG, HOME} <= set(df.columns):
        return None
    import json
    return json.loads(df.schema[SEG].metadata.get("layout", "null"))


def layout_columns(df: DataFrame) -> list[str]:
    """Columns that a projection must keep for a frame to stay in the stored layout."""
    return [POS, LEN, SEG, HOME] if stored(df) else []


def home_rows(df: DataFrame, keep: bool = False) -> DataFrame:
    """The rows of a frame in the stored layout, each once (with their segment if ``keep``); other
    frames as they are."""
    if not stored(df):
        return df
    df = df.filter(F.col(HOME)).drop(HOME)
    return df if keep else df.drop(SEG)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def bucket_expr(ts: str, unit: str = "month") -> Column:
    return F.date_trunc(unit, F.col(ts))


def resolve_unit(df: DataFrame, ts: str, unit: str) -> str:
    """'auto': calendar months for DATE series (daily bars: at most 31 rows per bucket), days for
    timestamps (intraday bars or ticks), so one (series, bucket) stays small."""
    if unit != "auto":
        return unit
    from pyspark.sql import types as T
    return "month" if isinstance(df.schema[ts].dataType, T.DateType) else "day"


def _maybe_broadcast(small: DataFrame) -> DataFrame:
    """Materialise a derived per-series table as parquet in the shared checkpoint folder.

    Read back as a file scan, its size is known to the planner, which broadcasts it only when
    the files are under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffle-joins it
    (AQE may still switch at run time) - a measured size check with a fallback. Writing it also
    cuts its lineage, so plans deriving several such tables from one input stay linear in size."""
    from tsforge.session import materialize
    return materialize(small)


LEN = "_len"


def with_positions(df: DataFrame, key="series_id", ts: str = "ts", unit: str = "auto", with_len: bool = False) -> DataFrame:
    """Add ``_pos``: the 1-based position of each row in its series ordered by ``ts`` (and,
    with ``with_len``, ``_len``: the series' row count, taken from the same small table).

    ``(key, ts)`` must be unique (see ``clean.dedupe``) so the order is total.
    """
    from tsforge.session import reuse_input
    if stored(df):
        return home_rows(df) if with_len else home_rows(df).drop(LEN)
    keys = _keys(key)
    unit = resolve_unit(df, ts, unit)
    b = reuse_input(df).withColumn(BUCKET, bucket_expr(ts, unit))
    counts = b.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy(*keys)).alias(LEN))
    j = b.join(_maybe_broadcast(offsets), keys + [BUCKET])
    local = Window.partitionBy(*keys, BUCKET).orderBy(ts)
    out = j.withColumn(POS, (F.col("_off") + F.row_number().over(local)).cast("bigint")).drop("_off", BUCKET)
    return out if with_len else out.drop(LEN)


def segmented(df: DataFrame, before: int | str = 0, after: int = 0, size: int = DEFAULT_SEGMENT_ROWS,
              key="series_id") -> DataFrame:
    """Assign ``_seg`` and add halo copies (``_home`` false) for frames reaching ``before``
    rows back and ``after`` rows ahead. ``before`` may name a column with each series' own reach
    (at most ``size``). Needs ``_pos`` from ``with_positions``."""
    if size < max(before if isinstance(before, int) else 1, after, 1):
        raise ValueError("segment size must be at least the halo width")
    if isinstance(before, str):
        before = F.col(before)
    i = F.col(POS) - 1
    seg = F.floor(i / size).cast("bigint")
    k = i - seg * size
    home = F.struct(seg.alias("s"), F.lit(True).alias("h"))
    nxt = F.when(k >= size - before, F.struct((seg + 1).alias("s"), F.lit(False).alias("h"))) if not isinstance(before, int) or before else None
    prv = F.when((k < after) & (seg > 0), F.struct((seg - 1).alias("s"), F.lit(False).alias("h"))) if after else None
    copies = [c for c in (home, nxt, prv) if c is not None]
    arr = F.filter(F.array(*copies), lambda c: c.isNotNull()) if len(copies) > 1 else F.array(home)
    return (df.withColumn("_cp", F.explode(arr))
              .withColumn(SEG, F.col("_cp.s")).withColumn(HOME, F.col("_cp.h")).drop("_cp"))


def segment_window(key="series_id") -> Window:
    return Window.partitionBy(*_keys(key), SEG).orderBy(POS)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(HOME, SEG)


def series_layout(df: DataFrame, before: int = 0, after: int = 0, key="series_id", ts: str = "ts",
                  size: int = DEFAULT_SEGMENT_ROWS, unit: str = "auto") -> DataFrame:
    """``with_positions`` (reused when ``_pos`` is already there) + ``segmented``. A frame in the stored
    layout that reaches far enough is taken as it is."""
    info = stored(df)
    if info and _keys(key) == _keys(info["key"]) and before <= info["before"] and after <= info["after"]:
        return df.drop(LEN)
    df = home_rows(df)
    d = df if POS in df.columns else with_positions(df, key, ts, unit)
    return segmented(d, before, after, size, key)


def running_sum(df: DataFrame, value: str, out: str, key="series_id", size: int = DEFAULT_SEGMENT_ROWS) -> DataFrame:
    """Cumulative sum of ``value`` over the whole series (rows ordered by ``_pos``).

    Two-level scan: local running sum inside each segment plus the sum of all earlier
    segments, taken from the small per-segment totals table.
    """
    keys = _keys(key)
    info = stored(df)
    if info and info["size"] <= size:  # the stored segments, so that the window needs no exchange
        d = home_rows(df, keep=True).withColumnRenamed(SEG, "_sseg")
    else:
        d = home_rows(df).withColumn("_sseg", F.floor((F.col(POS) - 1) / size).cast("bigint"))
    tot = d.groupBy(*keys, "_sseg").agg(F.sum(value).alias("_t"))
    prev = Window.partitionBy(*keys).orderBy("_sseg").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*keys, "_sseg", F.coalesce(F.sum("_t").over(prev), F.lit(0.0)).alias("_soff"))
    local = Window.partitionBy(*keys, "_sseg").orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return (d.join(_maybe_broadcast(offs), keys + ["_sseg"])
             .withColumn(out, F.col("_soff") + F.sum(value).over(local))
             .drop("_soff", "_sseg"))
