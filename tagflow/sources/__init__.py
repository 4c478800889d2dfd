"""Landed files in and out."""
