"""Runs the library over the given test tables: domain views, queries and their SQL twins."""
