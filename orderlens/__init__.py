"""orderlens: telecom order-line sales reporting on Spark DataFrames.

Layout:
  sources/    input views (warehouse tables, delimited reference files, test adapter)
  functions/  Column expressions: time helpers and the classification rules
  operators/  reusable DataFrame operators (latest row, windowed join, NOT IN, union)
  plans/      the report chain as DataFrame -> DataFrame stages, plus sinks
"""

from orderlens.sources.inputs import Inputs  # noqa: F401

__all__ = ["Inputs"]
