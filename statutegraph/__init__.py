"""Statute texts to knowledge-graph tables, as Spark jobs."""
