"""Session analytics on PySpark: recorded agent sessions to spans, evidence, gates and metrics."""
