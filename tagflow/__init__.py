"""Building-telemetry tables and training-data operators on PySpark."""
