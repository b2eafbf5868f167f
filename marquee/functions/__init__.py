"""Column -> Column building blocks."""
