"""Relational operators over telemetry tables."""
