"""Operators that prepare training data: filters, deduplication, mixing, packing, sharding.

Nothing else in the package imports this one.
"""
