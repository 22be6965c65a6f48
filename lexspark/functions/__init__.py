"""Column expressions: nulls, text, markup, nested values."""
