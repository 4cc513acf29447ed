"""Click-stream analytics as PySpark DataFrame operators and streaming queries."""
