"""Column expressions: text, dates, geometry, numbers and string similarity."""
