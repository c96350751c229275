"""Scans: list files, the source registry, message topics and layer tables."""
