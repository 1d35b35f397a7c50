"""Queries over the given tables, each next to the SQL that must agree with it."""
