"""Operators for large training corpora, one module per operator.

Nothing outside this package imports it. Every operator takes DataFrames and
names of columns, selects only those columns (so further columns of an input
never clash) and returns a DataFrame. ``catalog`` registers the queries.
"""
