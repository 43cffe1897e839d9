"""Column expressions and schema-time helpers."""
