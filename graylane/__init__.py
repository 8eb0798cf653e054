"""Spark-first operators for report captures: reading, history, reconciliation, facts."""
