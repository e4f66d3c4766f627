"""Whole jobs, composed of operators and sources."""
