"""Column builders: casts, null rules and date arithmetic."""
