"""Operators: functions DataFrame → DataFrame built from native Spark plans."""
