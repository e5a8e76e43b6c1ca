"""Scalar functions over log columns."""
