"""Column expressions and parameter handling shared by the operators."""
