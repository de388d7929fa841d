"""Column -> Column expressions."""
