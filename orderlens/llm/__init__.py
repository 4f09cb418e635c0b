"""Training-data operators: near-dedup, quality, tokens, WARC, PII, mixing, search, licenses.

Each module holds one operator with its own general interface; ``registry`` wraps them as the
registered queries.  Nothing outside this subpackage imports it.
"""
