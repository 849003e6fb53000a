"""Structured Streaming over a landing folder of records."""
