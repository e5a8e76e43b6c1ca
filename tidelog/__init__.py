"""Document change-data capture on Spark: change logs, namespaces, replay, reconciliation, targets."""
