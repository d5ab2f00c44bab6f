"""Column-expression helpers."""
