"""Blocklist lakehouse on Spark: lists and messages in, one row per domain out."""
