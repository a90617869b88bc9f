"""Column expressions and small statistics helpers."""
