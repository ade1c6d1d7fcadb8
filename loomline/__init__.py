"""Spark operators for session features, entity pairs, as-of features, recommendations and retrieval."""

__version__ = "0.1.0"
