"""Relational building blocks: table functions, search, change feed, checks."""
