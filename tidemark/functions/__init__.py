"""Column expressions that never throw on bad input."""
