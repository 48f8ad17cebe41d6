"""Equivalent SQL for every registered query, used as an independent check."""
