"""Positional UNION ALL with the column names of the first branch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_positional(first: DataFrame, *others: DataFrame) -> DataFrame:
    """``first UNION ALL others...``: columns pair by position and take ``first``'s names.

    Column types widen as in SQL; callers pass typed NULLs for filler columns so that a
    string filler never turns a timestamp or number column into text.
    """
    names = first.columns
    for o in others:
        if len(o.columns) != len(names):
            raise ValueError(f"UNION ALL branches differ in width: {len(names)} vs {len(o.columns)}")
    return reduce(lambda a, b: a.union(b.toDF(*names)), others, first)
