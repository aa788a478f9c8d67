"""Queries over the given tables, with the SQL that must agree with them."""
