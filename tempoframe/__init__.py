"""Spark operators for match events, ratings and dated valuations."""
