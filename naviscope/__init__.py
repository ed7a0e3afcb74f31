"""Scheme analytics on Spark DataFrames: feeds, pages, scores, labels, forests, rankings."""

__version__ = "0.1.0"
