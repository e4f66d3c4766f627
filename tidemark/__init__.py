"""Spark jobs that turn a versioned order change stream into a served table."""
