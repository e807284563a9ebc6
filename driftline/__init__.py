"""Incremental and change-data-capture tables as Spark jobs."""
