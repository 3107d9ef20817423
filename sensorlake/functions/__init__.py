"""Column expressions: scoring, levels, display."""
