"""Skew experiment (not a registered query): one hot series holding most rows plus many small
series, technical features with the segmented layout vs. whole-series windows.

Usage: python tools/skew_experiment.py [hot_rows] [small_series] [small_rows]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F  # noqa: E402

from tsforge.operators import features as fe  # noqa: E402
from tsforge.session import get_spark, materialize  # noqa: E402


def main():
    hot = int(sys.argv[1]) if len(sys.argv) > 1 else 4_000_000
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 1000
    m = int(sys.argv[3]) if len(sys.argv) > 3 else 1000
    spark = get_spark("local[8]", shuffle_partitions=64)
    base = F.to_timestamp(F.lit("2000-01-01"))
    hot_df = spark.range(hot).select(F.lit("hot").alias("series_id"), (base + F.make_interval(secs=F.col("id") * 60)).alias("ts"),
                                     (100 + F.sin(F.col("id") / 500.0) * 10 + F.rand(1)).alias("close"))
    small = spark.range(k * m).select(F.concat(F.lit("s"), (F.col("id") % k).cast("string")).alias("series_id"),
                                      (base + F.make_interval(days=(F.col("id") / k).cast("int"))).alias("ts"),
                                      (50 + F.rand(2) * 5).alias("close"))
    bars = materialize(hot_df.unionByName(small))
    out = {}
    for layout, kw in (("segmented", dict(unit="day")), ("series", dict(layout="series"))):
        t = time.time()
        fe.technical_features(bars, **kw).write.format("noop").mode("overwrite").save()
        out[layout] = round(time.time() - t, 1)
    print({"hot_rows": hot, "small_series": k, "small_rows": m, **out})


if __name__ == "__main__":
    main()
