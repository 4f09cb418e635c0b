"""Input views of the report: warehouse tables, delimited reference files, test adapter."""
