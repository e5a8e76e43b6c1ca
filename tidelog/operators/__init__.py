"""Filters, routing, field projection, replay, reconciliation, files and formatting."""
