"""Feeds, scans and table sinks."""
