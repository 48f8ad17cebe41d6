"""Multi-table reports built from the operators."""
