"""Operators: functions from DataFrames to DataFrames, no actions inside unless a docstring says so."""
