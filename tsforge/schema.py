"""Canonical schemas of the tables this package reads and writes."""

from pyspark.sql import types as T

# One row per (series, bar). ``ts`` is DATE for daily bars, TIMESTAMP for intraday.
BARS = T.StructType([
    T.StructField("series_id", T.StringType(), False),
    T.StructField("ts", T.DateType(), False),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# One long forecast table for every model (replaces the per-model CSV layouts).
FORECASTS = T.StructType([
    T.StructField("series_id", T.StringType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("ts", T.DateType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("actual", T.DoubleType()),
    T.StructField("forecast", T.DoubleType()),
])

METRICS = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# The raw daily-bar CSV layout the original scripts read (header row, one file).
STOCK_CSV = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("Brand_Name", T.StringType()),
    T.StructField("Ticker", T.StringType()),
    T.StructField("Industry_Tag", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("Dividends", T.DoubleType()),
    T.StructField("Stock Splits", T.DoubleType()),
    T.StructField("Capital Gains", T.DoubleType()),
])
