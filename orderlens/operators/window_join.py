"""Left outer join on equal keys and a symmetric time window, as a binned equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_within(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    left_seconds: Column,
    right_seconds: Column,
    max_gap: int,
) -> DataFrame:
    """``left LEFT JOIN right ON keys AND abs(right_seconds - left_seconds) < max_gap``.

    Matching on the key alone would compare every left row with every right row of the same
    key (all POS sales of a subscriber), and a busy key would be one huge task.  Instead time is
    cut into bins of width ``2 * max_gap``.  A right row at ``r`` can only match left rows in
    ``(r - max_gap, r + max_gap)``, which touches at most two bins: those of ``r - max_gap`` and
    ``r + max_gap``.  So each right row is copied into those (one or two) bins, and the join
    key becomes (key, bin).  Each left row has exactly one bin, so every qualifying pair meets
    exactly once, unmatched left rows stay once with NULLs, and the result equals the plain
    join.  Partner lists are bounded by the sales in a ``2 * max_gap`` span; the right side is
    shuffled at most twice over, and AQE can still split a skewed (key, bin) on the left.
    """
    width = 2 * max_gap
    lb = left.withColumn("_wj_ls", left_seconds).withColumn("_wj_bin", F.floor(F.col("_wj_ls") / width))
    rs = F.col("_wj_rs")
    rb = (
        right.withColumn("_wj_rs", right_seconds)
        .withColumn(
            "_wj_rbin",
            F.explode(F.array_distinct(F.array(F.floor((rs - max_gap) / width), F.floor((rs + max_gap) / width)))),
        )
    )
    cond = None
    for lk, rk in keys:
        c = lb[lk] == rb[rk]
        cond = c if cond is None else cond & c
    cond = cond & (lb["_wj_bin"] == rb["_wj_rbin"]) & (F.abs(rb["_wj_rs"] - lb["_wj_ls"]) < max_gap)
    return lb.join(rb, cond, "left").drop("_wj_ls", "_wj_bin", "_wj_rs", "_wj_rbin")
