"""Operators that prepare training text: capture archives, deduplication, language, tokens, packing, mixing, scoring."""
