"""Operators: functions from DataFrame to DataFrame that never trigger a job."""
