"""Column expressions: no DataFrame, no action, built-in functions only."""
