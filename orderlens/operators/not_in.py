"""SQL ``x NOT IN (subquery)`` as a distributed anti join with exact NULL semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of ``left`` whose ``left_key`` is NOT IN ``right.right_key``.

    SQL semantics: an empty list keeps every row (NULL keys too); otherwise a NULL key is
    dropped, and one NULL in the list drops every row.  Spark plans a literal NOT IN subquery
    as a null-aware anti join that always broadcasts the list; here the list is joined as a
    regular (shuffled or AQE-broadcast, size-checked) left anti join and the two NULL cases
    become two EXISTS subqueries that stop at the first row.
    """
    keys = right.select(F.col(right_key).alias("_nin_key"))
    # a key once: repeats collapse in the map-side aggregation, before the exchange
    anti = left.join(keys.distinct(), F.col(left_key) == F.col("_nin_key"), "left_anti")
    list_has_null = keys.where(F.col("_nin_key").isNull()).exists()
    list_non_empty = keys.exists()
    return anti.where(~list_has_null & (F.col(left_key).isNotNull() | ~list_non_empty))
