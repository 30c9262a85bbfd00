"""A stored positional layout: bars written once, bucketed by (series, segment), sorted by position.

Most operators need each row's position in its series and the rows around it. Computed anew each
time, that is a count, a join, a rank and an exchange per operator. ``store`` does it once: the table
holds ``_pos`` (1-based position), ``_len`` (rows of the series), ``_seg`` (segment) and ``_home``
(false for copies of neighbouring rows, so that frames of up to ``before`` rows back and ``after``
rows ahead see what they would see on the whole series). It is bucketed by (series, ``_seg``), so
windows over ``segments.segment_window`` start from the scan without an exchange, and it has a catalog
entry; ``attach`` makes that entry again in another application from the files alone.

The operators recognise such a table by the metadata of its ``_seg`` column, which filters, projections
and joins keep. Frames wider than the stored reach are laid out anew from the home rows.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.operators import segments as sg

BEFORE, AFTER = 256, 64       # reach of the stored copies
ROWS_PER_BUCKET = 1_000_000


def store(df: DataFrame, name: str | None = None, key: str = "series_id", ts: str = "ts", size: int = sg.DEFAULT_SEGMENT_ROWS,
          before: int = BEFORE, after: int = AFTER, buckets: int | None = None, path: str | None = None, unit: str = "auto") -> DataFrame:
    """Write ``df`` (unique in key and ts) in this layout under ``path`` (by default a new folder
    under the shared one) with a catalog entry ``name``, and return it as a frame."""
    from tsforge.session import checkpoint_dir, reuse_input
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:12]
    name = name or f"bars_{tag}"
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/layouts/{name}-{tag}"
    df = reuse_input(df.drop(sg.POS, sg.LEN, sg.SEG, sg.HOME))
    before, after = min(before, size), min(after, size)
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / ROWS_PER_BUCKET))
    rows = sg.segmented(sg.with_positions(df, key, ts, unit, with_len=True), before, after, size, key)
    info = {"layout": json.dumps({"key": key, "ts": ts, "size": size, "before": before, "after": after, "buckets": buckets})}
    rows = rows.withColumn(sg.SEG, F.col(sg.SEG).alias(sg.SEG, metadata=info))
    (rows.repartition(buckets, key, sg.SEG).write.format("parquet").option("path", path).mode("overwrite")
         .bucketBy(buckets, key, sg.SEG).sortBy(key, sg.SEG, sg.POS).saveAsTable(name))
    return spark.table(name)


def attach(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The layout stored under ``path``, entered in this application's catalog as ``name``."""
    schema = spark.read.parquet(path).schema
    got = json.loads(schema[sg.SEG].metadata["layout"])
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"`{got['key']}`, `{sg.SEG}`"
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}, `{sg.POS}`) "
              f"INTO {got['buckets']} BUCKETS LOCATION '{path}'")
    out = spark.table(name)
    return out.withColumn(sg.SEG, F.col(sg.SEG).alias(sg.SEG, metadata={"layout": json.dumps(got)}))
