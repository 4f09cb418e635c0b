"""Equi-join that shuffles both sides by an exchange of its own, so that a hot key's partition can be split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_own_exchange(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """``left JOIN right ON left_key = right_key`` for text keys; ``how`` is inner or left.

    Where several joins in a row have one key, Spark shuffles once for all of them, and then can't split a hot key's
    partition (it would have to shuffle again).  Here the join key is computed anew, which Catalyst doesn't take for
    the partitioning that a side may already have.  Adaptive execution then splits skewed partitions of the left side
    by default, with ``spark.sql.adaptive.forceOptimizeSkewedJoin`` or without.  Rows with a NULL key match nothing; in a left join they
    are kept out of the shuffle, where they would all meet in one partition, and are added with NULLs.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how}")
    anew = lambda c: F.concat(F.col(c), F.lit(""))
    keyed = left.where(F.col(left_key).isNotNull())
    joined = keyed.join(right.where(F.col(right_key).isNotNull()), anew(left_key) == anew(right_key), how)
    if how == "inner":
        return joined
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return joined.union(left.where(F.col(left_key).isNull()).select("*", *nulls))
