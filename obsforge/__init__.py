"""Observation analytics on Spark: validate, map, resolve, upsert and query."""
