"""Reusable DataFrame operators the report is built from."""

from orderlens.operators.key_filter import reduced_to_keys
from orderlens.operators.latest import latest_per_key
from orderlens.operators.not_in import not_in
from orderlens.operators.own_exchange import join_on_own_exchange
from orderlens.operators.pairing import pair_with_removed
from orderlens.operators.presence import flagged_values, presence_flags
from orderlens.operators.union import union_positional
from orderlens.operators.window_join import left_join_within

__all__ = [
    "flagged_values", "join_on_own_exchange", "latest_per_key", "left_join_within", "not_in", "pair_with_removed",
    "presence_flags", "reduced_to_keys", "union_positional",
]
