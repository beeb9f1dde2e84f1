"""Corpus analytics on Spark: index, search, count, verify and rate text collections."""
