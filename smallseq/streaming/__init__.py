"""Incremental variants of the batch aggregations."""
