"""Operators: functions from DataFrames to DataFrames, with no action inside."""
