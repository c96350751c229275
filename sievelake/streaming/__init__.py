"""Structured Streaming pipelines between the layers."""
