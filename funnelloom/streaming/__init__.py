"""Structured Streaming forms of the hourly board."""
