"""Readers for raw CSV extracts and for the tables of a layer."""
