"""Readers and writers: message topics, date-partitioned files, catalog tables."""
