"""Reconciliation, profiling, quality, schema history, lineage and leave marts on Spark DataFrames."""
