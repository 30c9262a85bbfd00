"""Projection, filtering and cleaning (P1-P14) and series gates (A1, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def extract_series(df: DataFrame, series: str, key: str = "series_id", drop: tuple = ()) -> DataFrame:
    """P1 + P2: rows of one entity, minus unwanted columns. Pushed down to the scan."""
    return df.filter(F.col(key) == series).drop(*drop)


def feature_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """Every numeric column except those excluded (label, date, keys)."""
    ex = {x.lower() for x in exclude}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name.lower() not in ex]


def parse_dates(df: DataFrame, col: str = "Date", out: str | None = None, fmt: str | None = None) -> DataFrame:
    """Text -> DATE; unparseable text becomes null instead of failing the job."""
    v = F.try_to_date(F.col(col), F.lit(fmt)) if fmt else F.try_to_date(F.col(col))
    return df.withColumn(out or col, v)


def to_naive_utc(df: DataFrame, col: str = "Date", out: str | None = None) -> DataFrame:
    """Zoned timestamp text -> instant -> naive UTC wall time (session zone must be UTC)."""
    return df.withColumn(out or col, F.to_timestamp(F.col(col)).cast("timestamp_ntz"))


def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    """P8 / P9 (``cols`` = all columns)."""
    return df.dropna(subset=cols)


def dedupe(df: DataFrame, tie: str, key: str = "series_id", ts: str = "ts") -> DataFrame:
    """One row for each (series, ts), the one with the largest ``tie``, so that window order is
    total and the same on every run. A partial aggregate, no window."""
    rest = [x for x in df.columns if x not in (key, ts)]
    last = df.groupBy(key, ts).agg(F.max_by(F.struct(*rest), tie).alias("_r"))
    return last.select(*[F.col(x) if x in (key, ts) else F.col(f"_r.`{x}`").alias(x) for x in df.columns])


def keep_values(df: DataFrame, col: str, values) -> DataFrame:
    """Membership filter (pushed to the scan as an In filter)."""
    return df.filter(F.col(col).isin(list(values)))


def positive_pairs(df: DataFrame, a: str = "actual", f: str = "forecast") -> DataFrame:
    """P10."""
    return df.filter((F.col(a) > 0) & (F.col(f) > 0))


def with_errors(df: DataFrame, a: str = "actual", f: str = "forecast") -> DataFrame:
    """Error and absolute error columns."""
    return df.withColumn("error", F.col(a) - F.col(f)).withColumn("abs_error", F.abs(F.col(a) - F.col(f)))


def missing_report(df: DataFrame, key: str = "series_id", cols: list[str] | None = None) -> DataFrame:
    """Rows and null count of every column, per series (long form)."""
    cols = cols or [x for x in df.columns if x != key]
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"),
                              *[F.count_if(F.col(x).isNull()).alias(x) for x in cols])
    return agg.unpivot([key, "n_rows"], cols, "column", "n_null")


def distinct_series(df: DataFrame, key: str = "series_id") -> DataFrame:
    """A1."""
    return df.select(key).distinct()


def length_gate(df: DataFrame, min_rows: int = 50, key: str = "series_id", value: str | None = None) -> DataFrame:
    """A2: keep only series with at least ``min_rows`` (non-null ``value``) rows.

    Counts per series are a partial aggregate; the gate is a left-semi join back."""
    cnt = F.count(F.lit(1)) if value is None else F.count(F.col(value))
    ok = df.groupBy(key).agg(cnt.alias("_n")).filter(F.col("_n") >= min_rows).select(key)
    return df.join(ok, key, "left_semi")


def series_lengths(df: DataFrame, key: str = "series_id", value: str | None = None) -> DataFrame:
    cnt = F.count(F.lit(1)) if value is None else F.count(F.col(value))
    return df.groupBy(key).agg(cnt.cast("bigint").alias("n"))

