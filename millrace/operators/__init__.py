"""Operators: functions from DataFrame to DataFrame, usable on batch input and,
unless they say otherwise, on stream input."""
