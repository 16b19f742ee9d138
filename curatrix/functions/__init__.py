"""Column expressions: text, geometry, hashing."""
