"""Latest version of each key: ``row_number() over (partition by key order by ...) = 1``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """Keep the first row of every key group under ``order_by``.

    ``order_by`` should end in columns that make the order total, so a recomputed partition
    (after a lost executor) picks the same row.  Catalyst plans the filter on the rank as a
    per-partition group limit below the shuffle, so only candidate rows are exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
