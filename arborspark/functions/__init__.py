"""Column expressions and small statistical helpers."""
