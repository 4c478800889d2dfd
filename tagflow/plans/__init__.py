"""Windows, days and batches as tables."""
