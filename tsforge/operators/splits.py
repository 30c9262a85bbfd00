"""Train/test splits by position (W11-W14) and the deterministic hash split (M2).

Positions come from ``segments.with_positions`` and series lengths from a per-series
count, so no split needs a descending window over a whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import segments as sg


def _with_pos_and_len(df: DataFrame, key, ts: str, unit: str) -> DataFrame:
    """Positions and series lengths; the lengths come with the positions' own count table
    (no extra pass) unless positions were already there."""
    keys = sg._keys(key)
    if sg.POS not in df.columns:
        return sg.with_positions(df, keys, ts, unit, with_len=True)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_len"))
    return df.join(sg._maybe_broadcast(n), keys)


def holdout_tail(df: DataFrame, h: int = 30, key="series_id", ts="ts", unit="auto", keep_pos=False) -> DataFrame:
    """``is_test`` marks the last ``h`` rows of each series; ``horizon`` numbers them 1..h."""
    d = _with_pos_and_len(df, key, ts, unit)
    test = F.col(sg.POS) > F.col("_len") - h
    d = (d.withColumn("is_test", test)
          .withColumn("horizon", F.when(test, (F.col(sg.POS) - (F.col("_len") - h)).cast("int"))))
    d = d.drop("_len")
    return d if keep_pos else d.drop(sg.POS)


def holdout_fraction(df: DataFrame, train_frac: float = 0.8, valid_frac: float = 0.0, key="series_id", ts="ts",
                     unit="auto", keep_pos=False) -> DataFrame:
    """First ``floor(train_frac * n)`` rows are training; of those, the last
    ``valid_frac`` (ordered, as a validation_split) become validation.

    ``split`` is 'train', 'valid' or 'test'."""
    d = _with_pos_and_len(df, key, ts, unit)
    n_train = F.floor(F.col("_len") * F.lit(train_frac))
    n_fit = F.floor(n_train * F.lit(1.0 - valid_frac))
    d = d.withColumn("split", F.when(F.col(sg.POS) <= n_fit, "train")
                                .when(F.col(sg.POS) <= n_train, "valid").otherwise("test")).drop("_len")
    return d if keep_pos else d.drop(sg.POS)


def hash_split(df: DataFrame, cols: list[str], train_pct: int = 80, seed: int = 42) -> DataFrame:
    """M2: a random-looking 80/20 split that does not change with partitioning
    (``randomSplit`` depends on the partition layout). The bucket is made of the first 32 bits of
    an md5 of the key columns as text, which any engine can repeat."""
    text = F.concat_ws("|", *[F.col(x).cast("string") for x in cols], F.lit(str(seed)))
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("split", F.when(bucket < train_pct, "train").otherwise("test"))


def numbered(df: DataFrame, key="series_id", ts="ts", unit="auto", out: str = "pos") -> DataFrame:
    """Rows with their 1-based position in the series."""
    return sg.with_positions(df, key, ts, unit).withColumnRenamed(sg.POS, out)
