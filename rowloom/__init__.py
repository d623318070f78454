"""Change capture, dimension history, reconciliation and ingestion on Spark DataFrames."""
