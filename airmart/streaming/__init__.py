"""Structured Streaming forms of the hourly loads."""
