"""Page-edit event ledger and read model on Spark DataFrames and Structured Streaming."""
