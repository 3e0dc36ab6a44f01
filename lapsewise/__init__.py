"""Churn analytics over user activity logs, written as plain Spark DataFrame functions."""
