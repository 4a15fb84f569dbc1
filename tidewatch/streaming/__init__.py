"""Structured Streaming jobs over change and event feeds."""
