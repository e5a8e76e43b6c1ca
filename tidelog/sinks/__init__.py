"""Targets that take upserts and deletes as DataFrames."""
