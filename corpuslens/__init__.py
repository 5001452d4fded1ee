"""Text-corpus analytics as Spark DataFrame jobs."""
