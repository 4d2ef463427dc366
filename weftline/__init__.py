"""Batch data patterns as Spark DataFrame functions."""
