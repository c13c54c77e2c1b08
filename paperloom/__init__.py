"""Paperloom: a scholarly corpus pipeline written as Spark DataFrame jobs."""
