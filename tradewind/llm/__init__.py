"""Training-data operators: dedup, mixing, extraction, scoring, sharding.

Nothing outside this package imports it; its queries live in ``queries.py``.
"""
