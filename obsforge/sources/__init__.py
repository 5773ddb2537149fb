"""Readers of landed response pages and the parquet star schema."""
