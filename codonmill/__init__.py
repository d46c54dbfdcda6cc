"""Spark jobs that turn landed genomics extracts into clean, linkable tables."""
