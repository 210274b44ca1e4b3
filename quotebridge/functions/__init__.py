"""Column expressions: everything here takes columns and returns columns."""
