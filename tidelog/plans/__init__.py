"""Whole replication jobs, and the registered queries."""
