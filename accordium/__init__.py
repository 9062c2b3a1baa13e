"""Spark-native data contracts, quality, privacy, erasure and lineage."""

__version__ = "0.1.0"
