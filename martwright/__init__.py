"""Governed customer and order analytics on Spark DataFrames."""
