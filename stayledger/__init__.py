"""stayledger: booking analytics as PySpark DataFrame functions."""
