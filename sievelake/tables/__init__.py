"""Catalog entries and upkeep of Parquet tables."""
