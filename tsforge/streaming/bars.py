"""Live OHLCV bars from a stream of raw ticks.

Ticks are read with ``readStream`` (file source here; any streaming source works), late rows
are bounded by a watermark, and bars are a grouped aggregation over tumbling event-time
windows per series. Output modes:

* ``update``: each micro-batch writes the bars it changed; the table of bars is the latest epoch of
  each bar. State is dropped once the watermark has passed a bar;
* ``append``: a bar is written once, after the watermark passes its window end.

Results go to a table in the shared checkpoint folder, one folder for each epoch (a retried epoch
overwrites its own). The query checkpoint sits next to it; a job started again under the same
``name`` resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.streaming.common import epoch_sink, stream_paths

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def tick_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", schema: T.StructType = EVENTS,
                files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of ``folder`` whose names match ``pattern`` (new files are
    picked up as they land)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(folder)


def live_bars(ticks: DataFrame, series: str = "event_type", ts: str = "ts", price: str = "value", width: str = "1 hour",
              late: str = "2 hours", tie: str = "event_id") -> DataFrame:
    """Streaming OHLCV: ``withWatermark`` needs a TIMESTAMP, so a naive ``ts`` is read as UTC. ``tie``
    orders ticks of one instant."""
    order = F.struct("_et", tie)
    t = ticks.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", late)
    return (t.groupBy(F.col(series).alias("series_id"), F.window("_et", width).alias("w"))
             .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
                  F.max_by(price, order).alias("close"), F.count(F.lit(1)).cast("bigint").alias("volume")))


def latest_bars(spark: SparkSession, out: str) -> DataFrame:
    """The bar table that ``update`` epochs add up to: of each bar, the last epoch's row."""
    rows = spark.read.parquet(out)
    cols = ["open", "high", "low", "close", "volume"]
    last = rows.groupBy("series_id", "ts").agg(F.max_by(F.struct(*cols), "epoch").alias("b"))
    return last.select("series_id", "ts", *[F.col(f"b.{c}").alias(c) for c in cols])


def run_live_bars(spark: SparkSession, folder: str, pattern: str = "*.parquet", mode: str = "update", name: str | None = None,
                  files_per_trigger: int | None = None, **kw) -> DataFrame:
    """Run the bar stream to the end of the available input (``availableNow``) and return the
    bar table written so far (batch DataFrame)."""
    ckpt, out = stream_paths(spark, name, "live_bars")
    bars = live_bars(tick_stream(spark, folder, pattern, files_per_trigger=files_per_trigger), **kw).select(
        "series_id", F.col("w.start").cast("timestamp_ntz").alias("ts"), "open", "high", "low", "close", "volume")
    q = (bars.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
             .foreachBatch(epoch_sink(out)).trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_bars(spark, out)
