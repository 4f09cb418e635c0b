"""The report chain: stages (``stages``), sinks (``sinks``) and the full run (``pipeline``)."""
