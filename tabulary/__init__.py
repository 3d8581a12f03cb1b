"""Spark jobs that turn untidy published figures into exact, merged, published tables."""

__version__ = "0.1.0"
