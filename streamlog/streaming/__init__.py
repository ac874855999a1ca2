"""Structured Streaming jobs over topic logs."""
