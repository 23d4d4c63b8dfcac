"""Column expressions: parsing, keys, text, dates and classes."""
