"""Column expressions: lenient parsing, rounding, tiers and display text."""
