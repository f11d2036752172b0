"""Registered queries: each reads the given tables and carries its SQL twin where one exists."""
