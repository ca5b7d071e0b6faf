"""Spark-native staging, export and query library for per-sample taxonomic profiles."""

__version__ = "0.1.0"
