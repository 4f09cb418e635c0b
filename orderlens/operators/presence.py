"""Per-key presence flags: which of a few values occur in a column within each group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def presence_flags(df: DataFrame, key: str, col: str, values: Mapping[str, str]) -> DataFrame:
    """One row per ``key`` with a boolean per ``values`` entry (flag name -> value).

    Replaces ``group_concat(distinct col)`` followed by substring tests: the flags are a
    map-side combinable aggregate (partial ``bool_or`` before the shuffle), so a key holding a
    large share of rows costs one partial row per task, not a long string.
    """
    return df.groupBy(key).agg(*[F.bool_or(F.col(col) == v).alias(name) for name, v in values.items()])


def flagged_values(values: Mapping[str, str], sep: str = ",") -> Column:
    """The values whose flag is set, sorted and joined: the distinct values of a key as text."""
    named = sorted((v, name) for name, v in values.items())
    # concat_ws leaves out what is NULL
    return F.concat_ws(sep, *[F.when(F.col(name), F.lit(v)) for v, name in named])
