"""Partitioned topic logs on Spark: offsets, confirmations, relays and writes as DataFrames."""
