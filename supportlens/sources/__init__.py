"""Readers for the six support tables and writers for derived tables."""
