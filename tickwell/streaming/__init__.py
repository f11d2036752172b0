"""Structured Streaming pipelines, sinks and run modes."""
