"""Sensor telemetry and table profiling on Spark DataFrames."""
