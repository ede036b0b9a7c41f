"""Moves and reconciles tables with PySpark DataFrames."""
