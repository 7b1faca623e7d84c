"""Column expressions: text, JSON, dates and typed parsing."""
