"""Column expressions and the few Arrow functions."""
