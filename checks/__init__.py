"""Operators bound to the test tables, and the SQL that gives the same answers."""
