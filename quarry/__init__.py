"""Spark-first engine for structuring, searching and evaluating document corpora."""

__version__ = "0.1.0"
