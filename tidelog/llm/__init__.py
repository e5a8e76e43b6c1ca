"""Operators for large-scale training-data preparation.

Nothing else in the package imports this one.  Every operator is a function from
DataFrame to DataFrame; ``queries`` holds the thin registered queries.
"""
