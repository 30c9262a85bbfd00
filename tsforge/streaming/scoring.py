"""R2: live scoring. Each series keeps its last ``lookback`` values; every new row with a full window
becomes a lag window, which a stateless fitted model (a Spark ML ``PipelineModel``/``Model``) scores.

Rows wait in the stream's state by (series, short span of event time): a grouped aggregation over
tumbling spans in append mode, so a hot series is spread over all tasks by its spans, a micro-batch
touches only the spans it has rows for, and a span leaves the state once the watermark has passed its
end (what waits within the ``late`` bound is in the state store on disk). A span's rows are used in order
of (microsecond, tie-break column), so rows may arrive in any order within the bound and ticks of
the same instant all count. Spark drops and counts only rows behind the watermark
(``numRowsDroppedByWatermark``).

The sink of a micro-batch links the spans that it gets: each span needs only the last ``lookback`` values
before it, which come from the ends of earlier spans of the batch and from the table of each series'
last values that the epoch before left (``carry``); a retried epoch reads the same one again and overwrites its
own. The windows of a span are then made in its own task.

A row without a value is a heartbeat: it makes no window, but moves the watermark on, so that a
quiet stream's last rows are released. A series is forgotten only if ``idle`` is given and it was
quiet (heartbeats count) for that long.
"""

from __future__ import annotations

import math
import time
import uuid

import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tsforge.session import checkpoint_dir, discard, materialize
from tsforge.streaming.bars import tick_stream
from tsforge.streaming.common import stream_paths

CARRY = "series_id string, span long, first long, seen long, tail array<double>"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _last(xs: Column, k: int) -> Column:
    """The last ``k`` items of an array, or all if there are fewer."""
    return F.when(F.size(xs) <= k, xs).otherwise(F.slice(xs, -k, k))


def link_spans(spans: DataFrame, lookback: int, idle_us: int | None = None) -> DataFrame:
    """Of closed spans (``CARRY``: number, first and newest event time in microseconds, last values) each
    series' span with ``prior``, the ``lookback`` values before it. Spans before a quiet time of
    ``idle_us`` are not looked at. One row for each span, whatever its rows."""
    order = Window.partitionBy("series_id").orderBy("span")
    quiet = F.lit(False) if idle_us is None else F.coalesce(F.col("first") - F.lag("seen").over(order) >= idle_us, F.lit(False))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    d = spans.withColumn("quiet", quiet.cast("long")).withColumn("life", F.sum("quiet").over(so_far))
    d = d.withColumn("nth", F.sum((F.size("tail") > 0).cast("long")).over(so_far))  # spans with values; each brings at least one
    before = Window.partitionBy("series_id", "life").orderBy("nth").rangeBetween(-lookback, -1)
    return d.withColumn("prior", _last(F.flatten(F.collect_list("tail").over(before)), lookback)).drop("quiet", "life", "nth")


def span_windows(spans: DataFrame, lookback: int) -> DataFrame:
    """Lag windows of spans with their ``rows`` in order and the ``prior`` values: series_id, ts, lags, target."""
    known = F.struct(F.concat("prior", F.transform("rows", lambda x: x["v"])).alias("v"), "rows", F.size("prior").alias("p"),
                     F.greatest(F.lit(lookback) - F.size("prior"), F.lit(0)).alias("lo"))

    def each(x):
        def window(i):
            return F.struct(F.timestamp_micros(F.get(x["rows"], i)["us"]).cast("timestamp_ntz").alias("ts"),
                            F.slice(x["v"], x["p"] + i - lookback + 1, lookback).alias("lags"), F.get(x["v"], x["p"] + i).alias("target"))
        n = F.size(x["rows"])
        return F.when(x["lo"] < n, F.transform(F.sequence(x["lo"], F.greatest(n - 1, x["lo"])), window))
    # the outer array of one item: the values are put together once for a span, not for each row
    return spans.select("series_id", F.flatten(F.transform(F.array(known), each)).alias("w")).select("series_id", F.inline("w"))


def _epochs(spark: SparkSession, folder: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(int(x.getPath().getName().split("=")[1]) for x in fs.listStatus(path) if "=" in x.getPath().getName()) if fs.exists(path) else []


def window_sink(spark: SparkSession, out: str, carry: str, lookback: int, idle_us: int | None = None, model=None):
    """``foreachBatch`` function for closed spans: writes the windows of a micro-batch (scored, with a
    ``model``) to a folder of its own epoch, and each series' last values beside it."""
    def sink(batch: DataFrame, epoch: int) -> None:
        made = materialize(batch)  # once; the state may not be read twice
        closed = spark.read.parquet(made._tsforge_path)
        old = [e for e in _epochs(spark, carry) if e < epoch]
        had = spark.read.parquet(f"{carry}/epoch={old[-1]}") if old else spark.createDataFrame([], CARRY)
        names = [f.split()[0] for f in CARRY.split(", ")]
        linked = materialize(link_spans(had.unionByName(closed.select(*names)), lookback, idle_us))
        last = F.max_by(F.struct("span", "first", "seen", _last(F.concat("prior", "tail"), lookback).alias("tail")), "span")
        now = linked.groupBy("series_id").agg(last.alias("x")).select("series_id", "x.*")
        if idle_us is not None:  # what comes after the spans of this batch is too late for these
            passed = closed.agg(F.max("end")).first()[0]
            now = now if passed is None else now.where(F.col("seen") + idle_us > passed)
        now.write.mode("overwrite").parquet(f"{carry}/epoch={epoch}")
        prior = linked.select(F.col("series_id").alias("s"), F.col("span").alias("k"), "prior")
        mine = F.col("series_id").eqNullSafe(F.col("s")) & (F.col("span") == F.col("k"))
        win = span_windows(closed.where(F.size("rows") > 0).join(prior, mine), lookback)
        if model is not None:
            win = model.transform(win.withColumn("features", array_to_vector("lags"))).drop("features")
        win.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        discard(made, linked)
    return sink


def _millis(bound: str) -> int:
    """Length of an interval like '2 hours'."""
    return int(pd.Timedelta(bound).total_seconds() * 1000)


def closed_spans(ticks: DataFrame, series: str = "event_type", ts: str = "ts", value: str = "value", tie: str = "event_id",
                 lookback: int = 20, late: str = "2 hours", span_ms: int | None = None) -> DataFrame:
    """The spans of a tick stream that the watermark has passed: series_id, span (number), first and
    seen (event times), end, rows (us, tie, v in order) and tail (the last ``lookback`` values). ``tie``
    orders rows of one instant; ``span_ms`` is the length of the spans (half the late bound)."""
    span = span_ms or max(1_000, _millis(late) // 2)
    et = F.col(ts).cast("timestamp")
    t = ticks.select(F.col(series).cast("string").alias("series_id"), F.unix_micros(et).alias("us"), F.coalesce(F.col(tie).cast("long"), F.lit(0)).alias("tie"),
                     F.col(value).cast("double").alias("v"), et.alias("_et")).withWatermark("_et", late)
    row = F.when(F.col("v").isNotNull() & ~F.isnan("v"), F.struct("us", "tie", "v"))
    g = t.groupBy("series_id", F.window("_et", f"{span} milliseconds").alias("w")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.min("us").alias("first"), F.max("us").alias("seen"))
    return g.select("series_id", F.floor(F.unix_micros("w.start") / F.lit(1000 * span)).alias("span"), "first", "seen",
                    F.unix_micros("w.end").alias("end"), "rows", F.transform(_last(F.col("rows"), lookback), lambda x: x["v"]).alias("tail"))


def stage_ticks(ticks: DataFrame, late_hours: int = 2, slice_rows: int = 2_000_000, file_rows: int = 500_000) -> tuple[str, int]:
    """Write a finite tick table as stream input: slices, one after the other, of the order of time plus
    a random delay of up to half the late bound (so rows are out of order, within the bound), and last
    one heartbeat for each series that lets the stream release all rows. Returns the folder and the
    files of each slice, which one trigger should take together.

    The table is read once for the slices' borders and once to write them: at least four slices, of about
    ``slice_rows`` rows, each in equally many files of about ``file_rows``. The stream takes files in the
    order of their times, so these are set in the order of the slices."""
    spark = ticks.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-input/{uuid.uuid4().hex}"
    delay = F.pmod(F.xxhash64("event_id"), F.lit(late_hours * 3_600_000_000 // 2))
    t = ticks.select("event_id", "ts", "event_type", "value").withColumn("_at", F.unix_micros(F.col("ts").cast("timestamp")) + delay)
    n = t.count()
    slices, files = max(4, math.ceil(n / slice_rows)), max(1, math.ceil(min(n, slice_rows) / file_rows))
    cuts = sorted(set(t.approxQuantile("_at", [i / slices for i in range(1, slices)], 0.1 / slices))) if n else []
    which = F.lit(0)
    for lo in range(0, len(cuts), 500):  # a short sum for each 500 borders
        which = which + F.aggregate(F.array(*[F.lit(int(c)) for c in cuts[lo:lo + 500]]), F.lit(0), lambda acc, c: acc + F.when(F.col("_at") > c, 1).otherwise(0))
    end = t.groupBy("event_type").agg((F.max("ts") + F.expr(f"INTERVAL {24 * 3650 + late_hours} HOURS")).alias("ts"))
    last = end.select(F.lit(None).cast("long").alias("event_id"), "ts", "event_type", F.lit(None).cast("double").alias("value"),
                      F.lit(len(cuts) + 1).alias("slice"))
    dealt = t.withColumn("slice", which).drop("_at")
    dealt = dealt.coalesce(1) if files == 1 else dealt.repartition(files, F.xxhash64("event_id"))
    dealt.write.partitionBy("slice").parquet(f"{base}/ticks")
    last.coalesce(1).write.mode("append").partitionBy("slice").parquet(f"{base}/ticks")
    _stamp(spark, f"{base}/ticks")
    return f"{base}/ticks", files


def _stamp(spark: SparkSession, folder: str) -> None:
    """Set the times of the files under ``folder``/slice=k in the order of k, two seconds apart."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts = sorted((int(x.getPath().getName().split("=")[1]), x.getPath()) for x in fs.listStatus(path(folder)) if "=" in x.getPath().getName())
    start = int(time.time() * 1000) - 2_000 * (len(parts) + 1)
    for k, (_, part) in enumerate(parts):
        for f in fs.listStatus(part):
            fs.setTimes(f.getPath(), start + 2_000 * k, -1)
            if abs(fs.getFileStatus(f.getPath()).getModificationTime() - (start + 2_000 * k)) >= 1_000:
                raise RuntimeError("replay needs a file system that keeps the modification times it is told")


def run_lag_windows(spark: SparkSession, folder: str, pattern: str = "*.parquet", lookback: int = 20, model=None,
                    name: str | None = None, files_per_trigger: int | None = 64, idle_hours: float | None = None, **kw) -> DataFrame:
    """Run R2 to the end of the available input; returns the written windows (scored with
    ``model`` when one is given: features = the window as a vector). Rows that the watermark has
    not passed stay in the state for the next run under the same ``name``. ``idle_hours`` (off by
    default) forgets a series that was quiet for that long."""
    ckpt, out = stream_paths(spark, name, "lag_windows")
    spans = closed_spans(tick_stream(spark, folder, pattern, files_per_trigger=files_per_trigger), lookback=lookback, **kw)
    idle = None if idle_hours is None else int(idle_hours * 3_600_000_000)
    sink = window_sink(spark, out, f"{out.rsplit('/', 1)[0]}/carry", lookback, idle, model)
    # The state store on disk, and as many stores as tasks can use (each costs a commit a micro-batch);
    # a query takes both when it starts.
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(8, 2 * spark.sparkContext.defaultParallelism))
    mine = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(parts)}
    before = {k: spark.conf.get(k) for k in mine}
    try:
        for k, v in mine.items():
            spark.conf.set(k, v)
        q = spans.writeStream.outputMode("append").option("checkpointLocation", ckpt).foreachBatch(sink).trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    q.awaitTermination()
    return spark.read.parquet(out).drop("epoch")


def replay(ticks: DataFrame, lookback: int = 20, model=None, late_hours: int = 2, **kw) -> DataFrame:
    """All windows of a finite tick table, through the stream, slice by slice."""
    base, files = stage_ticks(ticks, late_hours=late_hours)
    return run_lag_windows(ticks.sparkSession, base, "*.parquet", lookback, model, files_per_trigger=files, late=f"{late_hours} hours", **kw)
