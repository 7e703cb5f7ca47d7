"""Column expressions: scores, units, formats and pose arithmetic."""
