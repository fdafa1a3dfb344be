"""Structured Streaming jobs over behaviour streams."""
