"""Sensor-measurement pipeline on Spark: landing files in, day-partitioned warehouse, extracts out."""
