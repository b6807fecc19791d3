"""Operators: functions from DataFrame to DataFrame, usable with ``df.transform``."""
