"""Queries over the provided test tables, each with the SQL that must give the same rows."""
