"""Data reconciliation and mart operators on Spark DataFrames."""
