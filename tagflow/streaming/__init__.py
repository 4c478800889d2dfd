"""Structured Streaming forms of the scheduled five-minute feed."""
