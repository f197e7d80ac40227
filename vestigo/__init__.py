"""Document-lot audit engine expressed as PySpark plans."""
