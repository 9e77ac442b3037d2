"""Layered analytics over civic property extracts, written on the DataFrame API.

Raw CSV extracts land as all-string tables, are cleaned into typed entities and
are aggregated into reporting tables.  Every transformation is a function from
DataFrames to a DataFrame; only ``plans.pipeline`` writes.
"""
