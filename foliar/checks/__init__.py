"""Operators applied to the given test tables, each with the SQL that must agree."""
