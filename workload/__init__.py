"""Queries over the given test tables, each with the SQL it is checked against."""
