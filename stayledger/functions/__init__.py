"""Column to column functions; all stay inside Spark's native expressions."""
