"""Training-data operators: dedup, language ID, packing, scoring, formatting.

Each module holds one operator with a general interface; ``queries`` holds the
thin registered queries. Nothing outside this package imports it.
"""
