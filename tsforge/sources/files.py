"""File sources (S1-S6): CSV with an explicit schema, date parsing, multi-file forecast scans
that take the model name from the file name, and metrics tables."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.schema import STOCK_CSV


def read_csv(spark: SparkSession, path, schema: T.StructType | None = STOCK_CSV, infer: bool = False,
             date_col: str | None = None, date_format: str | None = None) -> DataFrame:
    """Header CSV with a declared schema (no inference pass over the data); ``infer=True``
    mirrors ``inferSchema``. ``date_col`` is parsed to DATE (``try_to_date``: bad text -> null)."""
    r = spark.read.option("header", True)
    r = r.option("inferSchema", True) if infer or schema is None else r.schema(schema)
    df = r.csv(path)
    if date_col:
        v = F.try_to_date(F.col(date_col), F.lit(date_format)) if date_format else F.try_to_date(F.col(date_col))
        df = df.withColumn(date_col, v)
    return df


def model_from_path(path_col="_metadata.file_path") -> F.Column:
    """File stem of a forecast file (``arima_forecast.csv`` -> ``arima_forecast``); for a
    Spark-written folder ``x.csv/part-*.csv`` the folder's stem."""
    return F.regexp_extract(F.col(path_col), r"([^/\\]+)\.csv(/[^/]*)?$", 1)


def headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The first line of each file (or folder of part files) of ``paths``, split into names, from
    one scan of the files' first blocks."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    lines = lines.where("b = 0").withColumn("i", F.monotonically_increasing_id())
    first = lines.groupBy("f").agg(F.min_by("value", "i").alias("h")).collect()  # one row for each file
    return {r["f"]: next(csv.reader([r["h"]])) for r in first}


def read_forecast_files(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """S3: several forecast CSVs in one scan; ``model`` from each file name. Columns are found by
    the files' own headers, so files may order them differently; a column that a file lacks is
    null, and columns beyond ``schema`` are left out. Text that does not parse becomes null."""
    groups: dict[tuple, list[str]] = {}
    for path, names in headers(spark, paths).items():
        groups.setdefault(tuple(names), []).append(path)
    out = None
    for names, files in sorted(groups.items()):
        raw = T.StructType([T.StructField(n, T.StringType()) for n in names])
        d = spark.read.option("header", True).schema(raw).csv(files)
        cols = [(F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields]
        d = d.select(*cols, model_from_path().alias("model"))
        out = d if out is None else out.unionByName(d)
    return out


def read_metrics_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S4 re-aimed: the metrics sheet as a table (``model`` + one column per metric)."""
    return spark.read.format(fmt).option("header", True).load(path)


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """First ``n`` rows in the order of the given columns (TakeOrdered, no global sort)."""
    return df.orderBy(*order).limit(n)
