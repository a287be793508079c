"""Operators of a training-data pipeline (tokenising, deduplication, filtering, search, sharding).

Nothing else in the library imports this subpackage; ``queries`` registers its queries.
"""
