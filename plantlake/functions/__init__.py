"""Column expressions: parsing, hashing and time arithmetic."""
