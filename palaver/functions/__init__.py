"""Column-level rules; all are built-in expressions."""
