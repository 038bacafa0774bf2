"""Column expressions: parsing, text, formatting and vector arithmetic."""
