"""Operators: functions from DataFrames to DataFrames. Reading and writing happen elsewhere."""
