"""Bar tables built from the driver's parquet tables (FIXTURES.md B1-B5).

Each builder returns the canonical bar layout ``series_id, ts, open, high, low, close, volume``
as a grouped aggregation; map-side partial aggregation keeps the shuffle to one row per
(series, bar, map task), so a series holding most of the raw rows does not concentrate work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.operators import segments as sg


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ohlcv(df: DataFrame, series, ts, price, order, volume=None) -> DataFrame:
    """Generic OHLCV bars: open/close are the price of the first/last row by ``order``."""
    vol = F.count(F.lit(1)) if volume is None else F.sum(volume)
    return (df.groupBy(series.alias("series_id"), ts.alias("ts"))
              .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"),
                   F.min(price).alias("low"), F.max_by(price, order).alias("close"),
                   vol.cast("bigint").alias("volume")))


def bars_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: one series per order priority, one bar per order date (5 series)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return ohlcv(o, F.col("o_orderpriority"), F.to_date("o_orderdate"), F.col("o_totalprice"), F.col("o_orderkey"))


def bars_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 series, ticker = priority|market segment (orders joined to customer)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(cu, o.o_custkey == cu.c_custkey)
    return ohlcv(j, F.concat_ws("|", "o_orderpriority", "c_mktsegment"), F.to_date("o_orderdate"),
                 F.col("o_totalprice"), F.col("o_orderkey"))


def bars_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3 series by return flag, daily revenue as close, quantity as volume."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice", "l_discount", "l_quantity")
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (li.groupBy(F.col("l_returnflag").alias("series_id"), F.to_date("l_shipdate").alias("ts"))
              .agg(F.round(F.sum(rev), 4).alias("close"), F.sum("l_quantity").cast("bigint").alias("volume")))


def bars_events(spark: SparkSession, sf_dir: str, unit: str = "hour") -> DataFrame:
    """Hourly (or daily) bars of event values per event type. ``ts`` is a TIMESTAMP."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    t = F.date_trunc(unit, F.col("ts").cast("timestamp")).cast("timestamp_ntz")
    return ohlcv(e, F.col("event_type"), t, F.col("value"), F.struct("ts", "event_id"))


def walk(bars: DataFrame, value: str = "close", out: str = "close", base: float = 1000.0, **kw) -> DataFrame:
    """B2: cumulative sum of the per-series standardised value, a non-stationary series.

    ``out = base + running_sum((v - mean) / std_pop)`` rounded to 6 decimals; the running
    sum is the two-level segmented scan, not a whole-series window."""
    from tsforge.session import reuse_input
    bars = reuse_input(bars)
    stats = bars.groupBy("series_id").agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd"))
    z = bars.join(sg._maybe_broadcast(stats), "series_id").withColumn("_z", F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd")))
    z = sg.with_positions(z, "series_id", "ts", kw.get("unit", "auto"))
    r = sg.running_sum(z, "_z", "_cz", size=kw.get("size", sg.DEFAULT_SEGMENT_ROWS))
    return r.withColumn(out, F.round(F.lit(base) + F.col("_cz"), 6)).drop("_mu", "_sd", "_z", "_cz", sg.POS)


def bars_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walk(bars_orders(spark, sf_dir)).select("series_id", "ts", "close")


FIXTURES = {
    "orders": bars_orders,
    "many": bars_many,
    "lineitem": bars_lineitem,
    "events": bars_events,
    "walk": bars_walk,
}
