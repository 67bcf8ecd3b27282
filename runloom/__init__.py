"""Sequencing-run analytics on Spark DataFrames."""
