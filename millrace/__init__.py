"""Millrace: medallion pipelines on Spark DataFrames, tables and streams."""
