"""Training-data operators: dedup, search, classification, tokens, packing, formatting, PII and sharding.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered queries.
"""
