"""Column expressions (scalar functions, H group)."""
