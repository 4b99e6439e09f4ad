"""Text-corpus and conversation analytics expressed as Spark DataFrame jobs."""
