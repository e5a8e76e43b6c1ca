"""Change logs, snapshots and chunked files as DataFrames."""
