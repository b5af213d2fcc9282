"""Queries over the given test tables and the SQL they are checked against."""
