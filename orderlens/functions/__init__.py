"""Column expressions: time helpers (``timefn``) and classification rules (``rules``)."""
