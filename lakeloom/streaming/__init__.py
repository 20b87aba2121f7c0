"""Structured Streaming replay of change logs."""
