"""Sensor-stream analytics as PySpark DataFrame transforms.

Every operation takes DataFrames and returns DataFrames, so the same code runs
on tables and inside Structured Streaming queries.
"""
