"""Structured Streaming form of the event grouping."""
