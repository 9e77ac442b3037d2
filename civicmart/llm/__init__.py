"""Operators of a training-data pipeline.

Every operator is a function from DataFrames to a DataFrame.  Nothing else in the
package imports this folder; its queries are in ``queries.py`` and their SQL in
``oracle.py``.
"""
