"""Sinks (K1-K5). Exports are partitioned writes; a single output file only for small results."""

from __future__ import annotations

from pyspark.sql import DataFrame

def write_single_csv(df: DataFrame, path: str) -> None:
    """K1: one CSV file. Partitions are computed in parallel, then one task streams them into the
    file in turn (it never holds them), so the time grows with the rows; use ``write_csv`` where
    several files will do."""
    df.repartition(1).write.option("header", True).mode("overwrite").csv(path)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K2: CSV export for BI tools, one folder per partition value (e.g. per model)."""
    w = df.write.option("header", True).mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K3."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_view(df: DataFrame, name: str) -> None:
    """K5: temp view for SQL users."""
    df.createOrReplaceTempView(name)
