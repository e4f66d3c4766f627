"""Structured Streaming around the batch job."""
