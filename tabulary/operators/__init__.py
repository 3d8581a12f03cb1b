"""Checks, merges, joins, aggregates and windows over DataFrames."""
