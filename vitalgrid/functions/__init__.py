"""Column expressions: parsing, coercion, text and label ladders."""
