"""Queries on the given tables that prove each operator, next to the SQL they must equal."""
