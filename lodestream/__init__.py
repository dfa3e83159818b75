"""lodestream: record extraction, classification and attribution on Spark DataFrames."""
