"""Operators: functions from DataFrames to DataFrames. None collects data or fixes a physical strategy."""
