"""veiltext - find and redact sensitive values in tables and streams of text, as Spark jobs."""
