"""Column expressions: text, time, JSON and vectors."""
