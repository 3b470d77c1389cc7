"""Structured Streaming form of the incremental import."""
