"""tsforge: per-series time-series analytics and forecasting as Spark DataFrame jobs.

Every operator takes a DataFrame keyed by ``(series_id, ts)`` and returns a DataFrame;
nothing loops over series on the driver.
"""

from tsforge.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
