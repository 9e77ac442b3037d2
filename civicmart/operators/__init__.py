"""Reusable DataFrame operators: de-duplication, medians, running totals, roll-ups."""
