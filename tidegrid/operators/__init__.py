"""Operators: functions from DataFrame to DataFrame."""
