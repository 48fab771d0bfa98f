"""Resumable model-generated columns as Spark jobs."""
