"""Operators: functions from DataFrame to DataFrame, built from Spark's own primitives."""
