"""Pairing of added with removed rows: every pair that agrees on the keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_with_removed(added: DataFrame, removed: DataFrame, keys: Sequence[str], carried: Mapping[str, str]) -> DataFrame:
    """Each row of ``added`` with each row of ``removed`` that has the same ``keys`` (m x n; a NULL key pairs with nothing).

    ``carried`` maps a column of ``removed`` to the name that it gets beside the columns of ``added``."""
    old = {k: f"_removed_{k}" for k in keys}
    right = removed.select(*[F.col(k).alias(o) for k, o in old.items()], *[F.col(c).alias(o) for c, o in carried.items()])
    on = [F.col(k) == F.col(o) for k, o in old.items()]
    return added.join(right, on, "inner").drop(*old.values())
