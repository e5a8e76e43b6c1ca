"""Tailing a change log with Structured Streaming."""
