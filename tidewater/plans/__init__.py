"""Whole jobs: the daily run, the warehouse load, and the queries over the given tables."""
