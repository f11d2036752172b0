"""Aggregations, queries, quality checks, versioned tables and monitoring rules."""
