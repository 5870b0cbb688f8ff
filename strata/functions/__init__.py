"""Column-expression building blocks (message validation)."""
